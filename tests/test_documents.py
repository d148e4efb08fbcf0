from __future__ import annotations

import json

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import geometry, paths, texts
from pagemill.functions.json import merged
from pagemill.operators import accuracy, pageplan, recognition, results
from pagemill.plans import registry
from tests.engine import PlainTextEngine


def col(spark, values, kind="string"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")


def apply(spark, values, make, kind="string"):
    return [r["o"] for r in col(spark, values, kind).select("k", make(F.col("v")).alias("o")).orderBy("k").collect()]


URLS = {
    "https://h/web/document-image-pdf/DOC742S1053//019957-01985-1.pdf": ("DOC742S1053", "019957-01985-1"), "x?Type=DOC/DOCC110901178/017744-02346-1.pdf": ("DOCC110901178", "017744-02346-1"),
    "/p/DOCC5/a.pdf": ("DOCC5", "a"), "/p/DOC7S1/b.pdf": ("DOC7S1", "b"), "/p/q.pdf": ("DOC", "q"), "": ("unknown", "document"), None: ("unknown", "document"), "abc": ("unknown", "document"),
}


def test_url_parts(spark):
    assert [tuple(x) for x in apply(spark, [*URLS], paths.url_parts)] == [*URLS.values()]


def test_relative_paths_and_alternates(spark):
    made = lambda v: paths.relative_path(paths.day_of_text(v), F.lit("DOCC5"), F.lit("a"))
    assert apply(spark, ["2020-02-12", None, "junk", "2024-01-02T23:30:00-05:00"], made) == ["2020/02/12/DOCC5_a.pdf", "unknown/DOCC5_a.pdf", "unknown/DOCC5_a.pdf", "2024/01/02/DOCC5_a.pdf"]
    one, other = apply(spark, ["d/DOCC1_016481-02124-1.pdf", "d/DOCC2_BM1965-00214-1.pdf"], paths.candidates)
    assert one == ["d/DOCC1_016481-02124-1.pdf", "d/DOCC1_016481-02124-1.pdf.pdf", "d/DOCC1_B: 016481 P: 02124-1.pdf", "d/DOCC1_B016481P02124-1.pdf", "d/DOCC1_B_016481_P_02124-1.pdf"]
    assert len(other) == 2
    assert apply(spark, ["/mnt/m/a.pdf", "/x/a.pdf", None], lambda v: paths.with_prefix(v, "/mnt/m", "/data")) == ["/data/a.pdf", "/x/a.pdf", None]


def test_files_are_found_under_the_first_name_that_exists(spark):
    rows = spark.createDataFrame([("d/DOCC1_1-2-3.pdf",), ("d/x.pdf",), ("d/y.pdf",)], "path string")
    disk = spark.createDataFrame([("d/DOCC1_B_1_P_2-3.pdf",), ("d/DOCC1_B1P2-3.pdf",), ("d/x.pdf.pdf",)], "path string")
    assert {r["path"]: r["found"] for r in pageplan.on_disk(rows, disk).collect()} == {"d/DOCC1_1-2-3.pdf": "d/DOCC1_B1P2-3.pdf", "d/x.pdf": "d/x.pdf.pdf", "d/y.pdf": None}


def test_blank_texts(spark):
    assert apply(spark, ["", " \n\t", " ", "a", None], texts.is_blank) == [True, True, True, False, True]


def page(status="success", *lines, path="p"):
    return {"status": status, "text_lines": [{k: v for k, v in (("text", t), ("confidence", c)) if v is not None} for t, c in lines]}


CASES = {
    "numeric order": ({"0": page("success", ("a", 0.9)), "10": page("success", ("c", 0.9)), "2": page("success", ("b", 0.9))}, ("a\n\nb\n\nc", 3, 90.0)),
    "error page": ({"0": page("error"), "1": page("success", ("x", 0.8), ("y", 0.6))}, ("x\ny", 2, 70.0)),
    "no lines": ({"0": page("success"), "1": page("success", ("z", 0.5))}, ("z", 2, 50.0)),
    "all errors": ({"0": page("error"), "1": page("error")}, ("", 2, 0.0)),
    "line without text": ({"0": page("success", (None, 0.7))}, ("", 1, 70.0)),
    "two lines without text": ({"0": page("success", (None, 0.5), (None, 0.7))}, ("\n", 1, 60.0)),
    "no confidence": ({"0": page("success", ("a", None), ("b", 0.8))}, ("a\nb", 1, 40.0)),
    "percentages": ({"0": page("success", ("a", 95.0))}, ("a", 1, 95.0)),
    "not weighted by lines": ({"0": page("success", ("a", 0.9)), "1": page("success", *[("b", 0.5)] * 9)}, ("a\n\n" + "\n".join("b" * 9), 2, 70.0)),
}


def test_page_results_become_documents(spark):
    jobs = spark.createDataFrame([(json.dumps({"job_id": name, "status": "completed", "results": {"/data/p.pdf": pages}}),) for name, (pages, _) in CASES.items()], "value string")
    rows = results.page_rows(results.parsed_jobs(jobs))
    got = {r["job_id"]: (r["full_text"], r["pages"], round(r["confidence"], 6)) for r in results.documents_of(rows, ["job_id", "path"]).collect()}
    assert got == {name: want for name, (_, want) in CASES.items()}


def test_metadata_keeps_nulls_and_merges_shallowly(spark):
    meta = results.metadata(F.lit("e"), F.lit("m"), F.lit("j"), F.lit(3), F.lit("completed"), F.lit(None).cast("double"))
    assert json.loads(spark.range(1).select(meta.alias("m")).first()["m"]) == {"engine": "e", "model": "m", "job_id": "j", "total_pages": 3, "job_status": "completed", "job_process_time": None}
    rows = spark.createDataFrame([('{"a":1,"b":{"c":2}}', '{"a":"x","d":null}'), (None, '{"k":1}'), ('{"k":1}', None)], "o string, n string")
    got = [json.loads(r["m"]) for r in rows.select(merged(F.col("o"), F.col("n")).alias("m")).collect()]
    assert got == [{"a": "x", "b": {"c": 2}, "d": None}, {"k": 1}, {"k": 1}]


def test_lookup_by_path_or_suffix(spark):
    targets = spark.createDataFrame([("/data/a/f.pdf",), ("/data/g.pdf",), ("/data/none.pdf",), ("/data/h.pdf",), ("/data/dir/",)], "target string")
    files = spark.createDataFrame([(0, "/x/prefix_f.pdf"), (1, "/data/a/f.pdf"), (2, "/x/prefix_g.pdf"), (3, "/y/h.pdf"), (4, "/x/h.pdf")], "ordinal int, path string")
    got = {r["target"]: r["path"] for r in results.by_suffix(targets, files).collect()}
    assert got == {"/data/a/f.pdf": "/data/a/f.pdf", "/data/g.pdf": "/x/prefix_g.pdf", "/data/none.pdf": None, "/data/h.pdf": "/y/h.pdf", "/data/dir/": "/x/prefix_f.pdf"}


def test_page_lists_and_shapes(spark):
    assert apply(spark, [0, 3, 30, 31], geometry.kept_pages, "int") == [[], [0, 1, 2], [*range(30)], [*range(25), *range(26, 31)]]
    shapes = {(1100, 850): (1088, 864), (1400, 850): (1408, 864), (1104, 848): (1088, 832), (1136, 1072): (1152, 1088), (3000, 2000): (1920, 1280), (10, 10): (32, 32)}
    rows = spark.createDataFrame([*shapes], "h int, w int")
    assert [tuple(r["s"]) for r in rows.select(geometry.detector_shape(F.col("h"), F.col("w")).alias("s")).collect()] == [*shapes.values()]
    near = spark.createDataFrame([(1920, 1280), (32, 32)], "h int, w int").select(geometry.nearest_shape(F.col("h"), F.col("w")).alias("s")).collect()
    assert [tuple(r["s"]) for r in near] == [(1792, 1184), (1056, 832)]
    crops = {(10, 10): 384, (320, 48): 384, (384, 48): 384, (385, 48): 512, (800, 20): 1920, (10000, 20): 3200}
    rows = spark.createDataFrame([*crops], "w int, h int")
    assert [r["x"] for r in rows.select(geometry.crop_width(F.col("w"), F.col("h")).alias("x")).collect()] == [*crops.values()]


def test_greedy_decoding(spark):
    one = lambda k, p: [p if i == k else 0.0 for i in range(3)]
    steps = [one(1, 0.9), one(1, 0.8), one(0, 0.7), one(1, 0.6), one(2, 0.5), one(2, 0.4), one(0, 0.3)]
    got = apply(spark, [steps, [one(0, 0.5)], [], [[0.5, 0.5, 0.0]]], lambda v: geometry.greedy_decode(v, ["", "a", "b"]), "array<array<double>>")
    assert [x["text"] for x in got] == ["aab", "", "", ""]
    assert got[0]["confidence"] == pytest.approx((0.9 + 0.6 + 0.5) / 3) and got[1]["confidence"] == 0.0


def test_polygons(spark):
    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [0.0, 2.0]]
    assert apply(spark, [square, [[0.0, 0.0], [1.0, 1.0]]], geometry.unclip_offset, "array<array<double>>") == [1.0, 0.0]


def test_reading_order_and_confident_lines(spark):
    line = lambda t, y, x, c=0.9: (t, c, [[float(x), float(y)]])
    rows = [[line("c", 2, 0), line("b", 1, 5), line("a", 1, 1), line("", 0, 0), line("d", 3, 0, 0.2), line("e", 2, 0, 0.3)]]
    got = apply(spark, rows, lambda v: F.transform(texts.confident_lines(texts.reading_order(v)), lambda x: x["text"]), texts.LINES)
    assert got == [["a", "b", "c", "e"]]


def test_similarity(spark):
    rows = spark.createDataFrame([("", ""), ("abcd", "bcde"), ("tide", "diet"), ("diet", "tide"), (None, "a")], "a string, b string")
    assert [r["s"] for r in rows.select(texts.similarity("a", "b").alias("s")).collect()] == [1.0, 0.75, 0.25, 0.5, 0.0]


def test_document_figures_keep_empty_pages(spark):
    rows = [("d", 0, [("a", 0.5, None)]), ("d", 1, []), ("d", 10, None), ("d", 2, [("b", 1.0, None), ("cc", None, None)])]
    got = accuracy.document_figures(spark.createDataFrame(rows, f"doc string, page int, lines {texts.LINES}"), ["doc"]).first()
    assert (got["pages"], got["lines"], got["chars"], got["avg_confidence"], got["full_text"]) == (4, 3, 4, 0.5, "a\n\n\n\nb\ncc\n\n")


def test_recognition_and_the_second_pass(spark):
    pages = spark.createDataFrame([(1, 0, b"one\ntwo"), (1, 1, None), (2, 0, b""), (3, 0, b"")], "document_id int, page int, image binary")
    read = recognition.recognised(pages, PlainTextEngine).withColumn("path", F.lit("p"))
    first = results.documents_of(read, ["document_id"])
    assert {r["document_id"]: (r["full_text"], r["pages"], round(r["confidence"], 6)) for r in first.collect()} == {1: ("one\ntwo", 2, 90.0), 2: ("", 1, 0.0), 3: ("", 1, 0.0)}
    again = lambda keys: keys.select("document_id", F.when(F.col("document_id") == 2, "found").otherwise(" ").alias("full_text"), F.lit(1).alias("pages"), F.lit(50.0).alias("confidence"))
    assert {r["document_id"]: r["full_text"] for r in recognition.with_second_pass(first, again).collect()} == {1: "one\ntwo", 2: "found"}


ODD_TEXTS = [None, "", " ", "\u00a0\n\t", "short", "?", "=", "word " * 120, " \n" * 300, "\u00a0" * 600]


def odd_documents():
    """Each odd text in each language and none, with its length or without; ids repeat and some are null."""
    rows = [(t, g, None if t is None or none else len(t)) for t in ODD_TEXTS for g in ("de", "en", None) for none in (False, True)]
    return [(None if k % 11 == 0 else k // 2 % 20, t, g, n) for k, (t, g, n) in enumerate(rows)]


@pytest.mark.parametrize("name", ["fallback_marks", "zero_text_split"])
def test_a_second_pass_over_odd_documents_agrees_with_its_sql(spark, tmp_path, name):
    spark.createDataFrame(odd_documents(), "doc_id long, text string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


class Failing:
    def read(self, image, dpi):
        raise ValueError("no")


def test_an_engines_error_is_a_failed_page(spark):
    pages = spark.createDataFrame([(1, 0, b"x")], "document_id int, page int, image binary")
    got = recognition.recognised(pages, Failing).first()
    assert (got["status"], got["error"], got["lines"]) == ("error", "no", None)


def test_numbering_over_ranges(spark):
    values = [5, 3, 3, None, 9, 1, 7] * 5
    rows = spark.createDataFrame([(v,) for v in values], "v int")
    got = pageplan.batches(rows, "v", 4).orderBy("ordinal").collect()
    assert [r["v"] for r in got] == sorted(values, key=lambda v: (v is not None, v or 0)) and [r["ordinal"] for r in got] == [*range(35)] and [r["batch"] for r in got] == [k // 4 for k in range(35)]
    assert pageplan.batches(rows.limit(0), "v", 4).count() == 0


def test_similarity_equals_a_plain_matcher(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(3)
    some = ["", None, "a", "a" * 150, "a" * 400, "ab" * 120, "x" * 199 + "y", *["".join(rng.choice("abc \n") for _ in range(rng.choice([3, 40, 250]))) for _ in range(12)]]
    rows = [(a, b) for a in some for b in some]
    got = spark.createDataFrame(rows, "a string, b string").select(texts.similarity("a", "b").alias("s")).collect()
    assert [r["s"] for r in got] == [SequenceMatcher(None, a or "", b or "").ratio() for a, b in rows]


LETTERS = st.sampled_from(["ab", "abc \n", "abcdefghijklmnopqrstuvwxyz    ", "".join(chr(0x4E00 + k) for k in range(120)), "a\U0001f388é"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(LETTERS, st.integers(0, 2**32), st.integers(0, 420), st.integers(0, 420), st.integers(0, 30)), max_size=6), st.sampled_from([3, 40, 1 << 20]))
def test_common_pieces_of_many_pairs_at_once(made, cells):
    """Pairs of a block are settled together, whatever number of places is held at a time."""
    import random
    from difflib import SequenceMatcher

    from pagemill.functions import matching

    pairs = []
    for letters, seed, n, m, edits in made:
        rng = random.Random(seed)
        a = [rng.choice(letters) for _ in range(n)]
        b = a[:m] if edits else [rng.choice(letters) for _ in range(m)]
        for _ in range(edits):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(3)] = [rng.choice(letters) for _ in range(rng.randrange(3))]
        pairs.append(("".join(a), "".join(b)))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(matching, "CELLS", cells)
        got = matching.shares([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_long_texts_are_compared_in_bounded_memory():
    import random
    import tracemalloc

    from pagemill.functions import matching

    rng = random.Random(5)
    letters = [chr(0x4E00 + k) for k in range(150)]
    a = "".join(rng.choice(letters) for _ in range(30_000))  # six million places with equal characters
    b = a[:9_000] + a[12_000:] + "".join(rng.choice(letters) for _ in range(3_000))
    tracemalloc.start()
    share = matching.shares([a], [b])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert share >= 0.9 and peak < 250e6


def test_turns_equal_a_plain_matcher(spark, sf):
    from difflib import SequenceMatcher

    from pagemill.plans.documents import text_similarity
    from pagemill.sources.tables import table

    said = {(r["conv_id"], r["turn"]): r["text"] or "" for r in table(spark, sf, "conversations").collect()}
    got = {(r["conv_id"], r["turn"]): r["similarity"] for r in text_similarity(spark, sf).collect()}
    assert got == {(c, t): SequenceMatcher(None, x, said[c, t + 1]).ratio() for (c, t), x in said.items() if (c, t + 1) in said}


def test_decoding_long_outputs(spark):
    import random

    from pagemill.functions.geometry import greedy_decode

    rng = random.Random(4)
    rows = [[[rng.choice([0.1, 0.5, 0.9]) for _ in range(4)] for _ in range(n)] for n in (0, 1, 2, 300, 300)]
    want = []
    for steps in rows:
        ks = [v.index(max(v)) for v in steps]
        kept = [i for i, k in enumerate(ks) if k and (i == 0 or k != ks[i - 1])]
        want.append(("".join(" ab "[ks[i]] if ks[i] else "" for i in kept), sum(max(steps[i]) for i in kept) / len(kept) if kept else 0.0))
    got = spark.createDataFrame([(r,) for r in rows], "steps array<array<double>>").select(greedy_decode(F.col("steps"), ["", "a", "b", " "]).alias("d")).select("d.*").collect()
    assert [r["text"] for r in got] == [t for t, _ in want] and all(abs(r["confidence"] - c) < 1e-9 for r, (_, c) in zip(got, want, strict=True))


def test_numbers_of_hot_keys_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(pageplan, "ROWS_OF_PART", 50)
    values = [None] * 150 + [7] * 300 + [*range(100)] + [7.5]
    rows = spark.createDataFrame([(k, v if v is None else float(v)) for k, v in enumerate(values)], "k int, v double").repartition(5)
    got = sorted((r["ordinal"], r["v"]) for r in pageplan.numbered(rows, "v").collect())
    assert [o for o, _ in got] == [*range(len(values))]
    assert [v for _, v in got] == sorted((v for v in values), key=lambda v: (v is not None, v or 0))
