"""An engine that needs no model: a page's bytes are its text."""

from __future__ import annotations


class PlainTextEngine:
    """An engine for tests and dry runs: a page's bytes are its text, at a fixed confidence."""

    def __init__(self, confidence: float = 0.9):
        self.confidence = confidence

    def read(self, image: bytes, dpi: int) -> list[dict]:
        lines = bytes(image).decode("utf-8", "replace").split("\n")
        return [{"text": t, "confidence": self.confidence, "bbox": [[0.0, float(k)]]} for k, t in enumerate(lines) if t]
