"""Registered queries against their SQL, and the pipeline against a plain computation, on the smallest tables."""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

duckdb = pytest.importorskip("duckdb")

import corpus_pipeline  # noqa: E402
from syncforge.llm.queries import ORACLE, QUERIES, pattern, tokenizer_path  # noqa: E402

SF_DIR = os.environ.get("SYNCFORGE_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    sql = con.execute(ORACLE[name])
    order = [d[0] for d in sql.description]
    assert sorted(order) == names
    want = sorted((tuple(r[order.index(c)] for c in names) for r in sql.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_return_every_row(spark, con, name):
    table, key = ("pages", "page_id") if "html" in name else ("embeddings", "vec_id") if "whitening" in name else ("documents", "doc_id")
    times = 16 if table == "embeddings" else 1
    got = sorted(r[0] for r in QUERIES[name](spark, SF_DIR).select(key).collect())
    assert got == sorted(times * [r[0] for r in con.execute(f"SELECT {key} FROM {table}").fetchall()])


def test_pipeline_against_plain_stages(spark, con):
    import base64

    import tiktoken

    word = "[^\x20\x09-\x0d]+"
    rows = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    rejected = {k for k, kept in con.execute(f"SELECT doc_id, kept FROM ({ORACLE['op2_quality_ledger']})").fetchall() if not kept}
    rows = {k: t for k, t in rows.items() if k not in rejected}
    sets = {}
    for k, t in rows.items():
        w = re.findall(word, t)
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    near = defaultdict(set)
    for a in rows:
        for b in rows:
            if a < b and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
    done: set[int] = set()
    for k in sorted(rows):
        if k not in done:  # the least of its class
            todo = [k]
            done.add(k)
            while todo:
                for b in near[todo.pop()] - done:
                    done.add(b)
                    del rows[b]
                    todo.append(b)
    seen: set[bytes] = set()
    for k in sorted(rows):
        b = rows[k].encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        kept, at = [], 0
        for c in rows[k]:
            n = len(c.encode())
            if not gone[at : at + n].all():
                kept.append(c)
            at += n
        rows[k] = "".join(kept)
    rows = {k: t for k, t in rows.items() if re.search(word, t)}
    code = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
    fold = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    phrases = set()
    for (t,) in con.execute("SELECT text FROM benchmark").fetchall():
        w = [fold(m[0]) for m in code.finditer(t or "")]
        phrases |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    for k, t in list(rows.items()):
        m = list(code.finditer(t))
        w = [fold(x[0]) for x in m]
        hit = np.zeros(len(w), bool)
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in phrases:
                    hit[i : i + n] = True
        out, at, i = [], 0, 0
        while i < len(w):
            if hit[i]:
                j = i
                while j + 1 < len(w) and hit[j + 1]:
                    j += 1
                out.append(t[at : m[i].start()])
                at, i = m[j].end(), j
            i += 1
        rows[k] = "".join([*out, t[at:]])
        if hit.any() and not code.search(rows[k]):
            del rows[k]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
    want = sorted((k, own.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest(), len(t)) for k, t in rows.items())
    got = sorted((r["doc_id"], r["ids"], r["decoded_sha256"], r["n_chars"]) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert [g[0] for g in got] == [w[0] for w in want]
    assert got == want
    assert Counter(n for n, _ in corpus_pipeline.STAGES).total() == 5


def test_pipeline_on_odd_rows_and_an_empty_table(spark, tmp_path):
    """Null, empty and repeated rows, null keys, a very long text: every stage runs, clean documents come through whole."""
    clean = " ".join(f"clean{i} words{i * i}" for i in range(60))
    other = " ".join(f"other{i} text{i * 7}" for i in range(60))
    rows = [(1, clean, "en", "a", len(clean)), (1, clean, "en", "a", len(clean)), (None, other, None, None, None), (2, None, "en", "a", 0), (3, "", "en", "a", 0), (4, "spam " * 5000, "en", "a", 25_000)]
    rows += [(5, " ".join(f"long{i}" for i in range(30_000)), "en", "b", 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    spark.createDataFrame([], kind).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for d in ("odd", "none"):
        spark.createDataFrame([(1, "no such words anywhere")], "item_id long, text string").write.parquet(str(tmp_path / d / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    texts = {1: clean, None: other, 5: rows[-1][1]}
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(texts, key=str)
    assert {r["doc_id"]: r["decoded_sha256"] for r in got} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
