"""The pipeline against a plain version of its five stages, and each stage's contract."""

import io
import tempfile
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import edited, plain_components, plain_quality

import corpus_pipeline
from tagloom.llm import mixing, quality, token_output
from tagloom.llm.seekable import Reader

STOPS = "the of and to in is that it for on was with".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(STOPS[rng.integers(0, 12)] if k % 3 == 0 else f"w{rng.integers(0, 5000)}" for k in range(n))


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    items = [(i, prose(9000 + i, 30)) for i in range(5)]
    rows = [(i, prose(i, 120), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, edited(rows[i][1], i, 2), "en", "s0") for i in range(10)]  # near copies
    rows += [(200 + i, rows[20][1], "en", "s1") for i in range(10)]  # exact copies
    rows += [(300 + i, prose(500 + i, 60) + " " + items[i % 5][1] + " " + prose(600 + i, 60), "en", "s2") for i in range(8)]
    rows += [(400, None, None, None), (401, "", "en", "s0"), (402, "short text", "en", "s0"), (403, "junk " * 200, "en", "s1"), (404, prose(7, 100).upper() + "!!", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, items


def plain(rows, items):
    from tokenizers import Tokenizer

    stop = {w for v in quality.STOP_WORDS.values() for w in v.split()}

    def good(t):
        t = t or ""
        n, chars, symbols, _, repeated = plain_quality(t)
        if n < 20 or 100 * repeated > 30 * n:
            return False
        words, lines = t.split(), [x for x in t.split("\n") if x.split()]
        return all([
            2 * n <= chars <= 14 * n, symbols <= 0.25 * n, len(lines) - len(set(lines)) <= 0.5 * len(lines), sum(w.lower() in stop for w in words) >= 0.04 * n,
            sum(c.isupper() for c in t) <= 0.4 * chars, t.count("!") <= 0.5 * n, sum(a == b for a, b in zip(words, words[1:])) <= 0.2 * n,
        ])

    rows = [r for r in rows if good(r[1])]
    least = {d: c for d, _, c in plain_components([(r[0], r[1]) for r in rows], 80)}
    rows = [r for r in rows if least[r[0]] == r[0]]
    rows = [r for r in rows if not any(t in r[1] for _, t in items)]
    t, out, start = Tokenizer.from_file(token_output.tokenizer_path()), [], 0
    for r in sorted(rows):
        ids = np.array([*t.encode(r[1], add_special_tokens=False).ids, 2], "<u4")
        out.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_pipeline_against_plain_version(spark, case):
    d, rows, items = case
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, d).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == plain(rows, items)
    assert not {d for d, *_ in got} & {*range(200, 210), *range(300, 308), *range(400, 405)} and len(got) == 60


def test_stages_keep_the_columns_and_empty_tables(spark, case):
    d = case[0]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("doc_id < 5"), d).columns == docs.columns
        assert stage(spark, docs.where("false"), d).count() == 0
    assert corpus_pipeline.source_mixing(spark, docs, d).count() == docs.count()


def test_token_files_follow_the_mix(spark, case):
    d = case[0]
    got = corpus_pipeline.run(spark, d).collect()
    kept = spark.read.parquet(f"{d}/documents.parquet").where(F.col("doc_id").isin([r.doc_id for r in got]))
    order = [r.doc_id for r in sorted(mixing.mix(spark, kept).select("doc_id", "position").collect(), key=lambda r: r.position)]
    rows = sorted(got, key=lambda r: r.file_start)
    assert [r.doc_id for r in rows] == order != sorted(order)
    assert [r.file_start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]


def test_files_of_another_order(spark):
    d = spark.createDataFrame([(i or None, f"text {i}", -i) for i in range(40)], "doc_id bigint, text string, at bigint")
    rows = token_output.write_tokens(spark, d, f"file://{tempfile.mkdtemp()}", token_output.tokenizer_path(), 2, frame_bytes=60, order="at").collect()
    files = [Path(r.path.removeprefix("file://")).read_bytes() for r in sorted(rows)]
    readers = [Reader(io.BytesIO(x), len(x)) for x in files]
    assert [i for r in readers for i, _ in r.documents()] == [*range(39, 0, -1), None]
    assert all(sum(len(r.find(i)) for r in readers) == 1 for i in range(1, 40))


def test_stages_with_clashing_columns_and_equal_ids(spark, case):
    """Columns named like those that the stages make, and rows of one id with different texts, null texts and repeats."""
    d, base = case[0], prose(77, 150)
    rows = [(1, base), (1, edited(base, 1, 2)), (1, prose(78, 150)), (1, None), (1, ""), (1, None), (2, base), (None, base), (None, base), (3, prose(79, 80))]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id bigint, text string, lang string, source string")
    names = ["position", "slot", "block", "source_rank", "text_hash", "text_md5", "leaked_id", "leaked_hash", "_text", "_id", "key", "kept", "c0"]
    docs = docs.withColumns({n: F.lit(f"my {n}") for n in names})
    once = corpus_pipeline.minhash_near_dedup(spark, docs, d)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "", r.text is None) for r in once.collect()))
    first = min(((1, base), (1, edited(base, 1, 2))), key=lambda r: spark.range(1).select(F.xxhash64(F.lit(r[1]))).first()[0])[1]
    assert got == sorted([(False, 0, base, False)] * 2 + [(True, 1, first, False), (True, 1, rows[2][1], False), (True, 1, "", True), (True, 1, "", False), (True, 3, rows[9][1], False)])
    for stage in (corpus_pipeline.minhash_near_dedup, corpus_pipeline.benchmark_decontamination, corpus_pipeline.source_mixing):
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and all(r[n] == f"my {n}" for r in out.collect() for n in names)
    assert corpus_pipeline.token_files(spark, docs, d).count() == len(rows)
