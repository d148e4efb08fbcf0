"""Document names and file paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL patterns in the order in which they are tried; the last has no document part.
URL_PATTERNS = [
    r"/document-image-pdf/([^/]+)//([^/]+)\.pdf",
    r"Type=DOC/(DOCC\d+)/([^/]+)\.pdf",
    r"/(DOCC\d+)/([^/]+)\.pdf",
    r"/(DOC[^/]+)/([^/]+)\.pdf",
]
FILE_PATTERN = r"/([^/]+)\.pdf"
NUMBERED_NAME = r"^(DOC[^_]+)_(\d+)-(\d+)-(\d+)\.pdf"


def url_parts(url: Column) -> Column:
    """Struct (doc_id, name) of a URL; ``unknown``, ``document`` for null, empty or other URLs."""
    part = lambda doc, name: F.struct(doc.alias("doc_id"), name.alias("name"))
    out = F.when(url.rlike(URL_PATTERNS[0]), part(*[F.regexp_extract(url, URL_PATTERNS[0], k) for k in (1, 2)]))
    for p in URL_PATTERNS[1:]:
        out = out.when(url.rlike(p), part(*[F.regexp_extract(url, p, k) for k in (1, 2)]))
    out = out.when(url.rlike(FILE_PATTERN), part(F.lit("DOC"), F.regexp_extract(url, FILE_PATTERN, 1)))
    return out.otherwise(part(F.lit("unknown"), F.lit("document")))


def day_of_text(value: Column) -> Column:
    """The calendar day that a date text names in its own offset; null if it is none."""
    return F.try_to_timestamp(F.substring(value, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def relative_path(day: Column, doc_id: Column, name: Column) -> Column:
    """``YYYY/MM/DD/doc_name.pdf``, or ``unknown/doc_name.pdf`` without a day."""
    folder = F.coalesce(F.date_format(day, "yyyy/MM/dd"), F.lit("unknown"))
    return F.concat(folder, F.lit("/"), doc_id, F.lit("_"), name, F.lit(".pdf"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def candidates(path: Column) -> Column:
    """All names under which a file may lie, in the order in which they are tried."""
    name, folder = basename(path), folder_of(path)
    number = [F.regexp_extract(name, NUMBERED_NAME, k) for k in (1, 2, 3, 4)]
    under = lambda form: F.concat(folder, F.lit("/"), F.format_string(form, *number))
    others = F.array(*[under(f) for f in ("%s_B: %s P: %s-%s.pdf", "%s_B%sP%s-%s.pdf", "%s_B_%s_P_%s-%s.pdf")])
    twice = F.when(path.endswith(".pdf"), F.array(F.concat(path, F.lit(".pdf")))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(path), twice, F.when(name.rlike(NUMBERED_NAME), others).otherwise(F.array().cast("array<string>")))


def with_prefix(path: Column, old: str, new: str) -> Column:
    """``path`` with its prefix ``old`` replaced; other paths stay as they are."""
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substr(path, F.lit(len(old) + 1)))).otherwise(path)
