"""Run detection, WARC archives and whitening against plain computations, on odd rows and on empty tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from syncforge.llm import runs, warc, whitening

# periodic runs


def plain_runs(w):
    """Every maximal stretch of each period, shortest period first."""
    seen = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                seen.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in seen.items())


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_periods(seed):
    rnd = random.Random(seed)
    for _ in range(80):
        texts = []
        for _ in range(rnd.choice([1, 3, 8])):
            k, n, w = rnd.choice([1, 2, 2, 3, 5, 30]), rnd.choice([0, 1, 5, 6, 7, 20, 60, 200]), []
            while len(w) < n:
                w += [rnd.randrange(k) for _ in range(rnd.randint(1, 6))] * (rnd.randint(1, 9) if rnd.random() < 0.4 else 1)
            texts.append(w[:n])
        first = np.cumsum([0, *map(len, texts)])
        got = runs.runs_of(np.array([x for t in texts for x in t], np.int64), first)
        want = sorted((int(first[i]) + s, q, int(first[i]) + e) for i, t in enumerate(texts) for s, q, e in plain_runs(t))
        assert [(s, q, e) for s, e, q in zip(*(x.tolist() for x in got), strict=True)] == want


def test_grammar_derives_the_words():
    rnd = random.Random(3)
    words = np.array([rnd.randrange(4) for _ in range(500)])
    g = runs.Grammar(words, np.array([0, 200, 200, 500]))
    left, right, first = (np.concatenate(x) for x in (g.left, g.right, g.first))
    assert len(left) == g.n_nodes < 498  # pairs that come again share a node
    for node, place in zip(*(np.concatenate(x) for x in zip(*g.places, strict=True)), strict=True):
        n, a = int(left[node] + right[node]), int(first[node])
        assert (words[place : place + n] == words[a : a + n]).all()
        assert (place < 200) == (place + n <= 200)  # no node crosses from text to text


def test_long_runs_are_linear():
    for w in ([0] * 200_000, ([0] * 50 + [1]) * 4000):
        got = runs.runs_of(np.array(w), np.array([0, len(w)]))
        assert (got[1] - got[0]).max() == len(w)


def test_detect_rows(docs, none):
    def row(key, text):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        if key is not None and words and (h := zlib.crc32(str(key).encode())) % 10 == 0:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        found = plain_runs(words) if len(words) < 5000 else [(0, 1, len(words))]  # the one long text is one word repeated
        best = max(found, key=lambda r: (r[2] - r[0], -r[0], -r[1]), default=None)
        gone = {i for s, q, e in found for i in range(s + q, e)}
        told = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
        one = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        return (key, len(found), *one, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())

    spark = docs.sparkSession
    more = [(k, " ".join(f"w{i % 37}" for i in range(k % 90))) for k in range(100, 400)]
    for df in (docs.select("doc_id", "text"), spark.createDataFrame(more, "doc_id long, text string")):
        got = sorted(map(tuple, runs.detect(df, change=runs.period_change, keep=()).collect()), key=str)
        assert got == sorted((row(r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in more)
    assert runs.detect(none).collect() == []


def test_detect_spans_and_text(spark):
    df = spark.createDataFrame([(1, "x " + "a b " * 5 + "y"), (2, "spam " * 6)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.detect(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 10, 2)] and got[1]["collapsed"] == "x a b y"
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 6, 1)] and got[2]["collapsed"] == "spam"


# archives


def fake(page):
    return (warc.record("response", page, "http://x", b"\0" * 20, b"fake", 4) + b"\r\n\r\n").decode()


def odd_pages():
    rows = []
    for i in range(60):
        html = ["plain %d" % i, "same", None, "", "has WARC/1.1\r\n inside %d" % i, "x" * 200 * i, fake(7) * i, "é" * 100 + fake(8) + "WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"][i % 8]
        rows.append((i, f"u{i}", html, "x", i))
    return rows + [(3, "u3", "", "y", 0), (3, "u3", "", "y", 0), (None, None, "same", "z", 1), (None, "é\r\n x", None, None, 2), (5, "u5", "zz", "", 3)]


def b32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


@pytest.mark.parametrize("split", [3000, 1 << 20])
def test_archive_round_trip(spark, split):
    rows = odd_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, k long").repartition(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        path = warc.fresh_path(spark)
        warc.write(pages, path)
        narrow = warc.read(spark, path).collect()
        got = warc.read(spark, path, payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted((tuple(r) for r in narrow), key=str) == sorted((tuple(r)[:-1] for r in got), key=str)
    assert all(r["intact"] for r in got)
    want = sorted(((k, len((h or "").encode()), b32((h or "").encode())) for k, _, h, *_ in rows), key=str)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got), key=str) == want
    keys = defaultdict(list)
    for k, _, h, *_ in rows:
        keys[(h or "").encode()].append(k)
    responses = [r for r in got if r["record_type"] == "response"]
    assert sorted(bytes(r["payload"]) for r in responses) == sorted(keys)
    least = {b32(h): min((k for k in ks if k is not None), default=None) for h, ks in keys.items()}
    assert all(r["page_id"] == least[r["payload_digest"]] and r["refers_to"] is None for r in responses)
    assert all(r["refers_to"] == least[r["payload_digest"]] for r in got if r["record_type"] == "revisit")


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (2, "b", "x"), (3, "c", "long text"), (4, "d", "long text")], "page_id long, url string, html string")
    path = warc.fresh_path(spark)
    warc.write(pages, path, least_bytes=5)
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read(spark, path).collect())
    assert got == [(1, "response", None), (2, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_cut_off_and_foreign_records(spark, tmp_path):
    good = [warc.record("response", i, f"u{i}", hashlib.sha1(b"p%d" % i).digest(), b"p%d" % i, 2) + b"\r\n\r\n" for i in range(4)]
    (tmp_path / "cut.warc").write_bytes(b"".join(good)[:-7])  # the last record's end is missing
    (tmp_path / "start.warc").write_bytes(b"noise" + b"".join(good))  # no record at the first byte
    got = warc.read(spark, str(tmp_path)).collect()
    assert sorted((r["file"].rpartition("/")[2], r["page_id"]) for r in got) == [("cut.warc", 0), ("cut.warc", 1), ("cut.warc", 2)]


def test_empty_archive(spark):
    path = warc.fresh_path(spark)
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).collect() == []


# whitening


def test_counts_above():
    rnd = np.random.default_rng(0)
    for d in (1, 2, 3, 7, 30):
        a = rnd.standard_normal((d, d))
        a += a.T
        values = np.linalg.eigvalsh(a)
        for shift in rnd.uniform(values[0] - 1, values[-1] + 1, 25):
            assert whitening.above(a, shift) == (values > shift).sum()


def test_leading_eigenvectors():
    rnd = np.random.default_rng(1)
    turn = np.linalg.qr(rnd.standard_normal((11, 11)))[0]
    for values in (rnd.uniform(0.1, 9, 11), [3, 3, 3, 2, 2, 1, 1, 1, 1, 0, 0], [1, 1 + 1e-13, 1 + 1e-9, 1e-3, 1e-9, 0, 0, 0, 0, 0, 0]):
        v = turn @ np.diag(values) @ turn.T
        v = (v + v.T) / 2
        e, x = whitening.leading(v, 8)
        want = np.sort(values)[::-1]
        want = want[: min(8, int((want > 1e-12).sum()))]
        assert len(e) == len(want) and np.abs(e - want).max() < 1e-12
        assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12 and np.abs(v @ x - x * e).max() < 1e-12


def plain_whitening(rows, k):
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, {i: int(((n * y - s) ** 2).sum()) for i, y in x.items()}, e / np.trace(v), {i: (y - s / n) @ u / np.sqrt(e) for i, y in x.items()}


@pytest.mark.parametrize("width", [1, 3, 24])
def test_whitening(spark, width):
    rnd = np.random.default_rng(width)
    rows = [(i, (rnd.standard_normal(width) * np.linspace(3, 0.5, width)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]
    odd = [(2000, None), (2001, [None] * width), (2002, [float("nan")] * width), (2003, [float("inf")] * width), (2004, []), (2005, [1.0] * (width + 1))]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, n long, component string")
    got = whitening.whiten(df.repartition(5)).collect()
    k = min(width, 16)
    n, deviation, explained, white = plain_whitening(rows, k)
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c + 1) for i, _ in rows for c in range(k))
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        i, c = r["vec_id"], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[c] - 1) < 1e-9
        sign.setdefault(c, np.sign(r["whitened"] * white[i][c]))
        assert abs(r["whitened"] - sign[c] * white[i][c]) < 1e-7


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []  # nothing varies
    got = whitening.whiten(spark.createDataFrame([(None, [0.0, 5.0]), (2, [1.0, 5.0]), (2, [1.0, 5.0]), (None, [1e300, 5.0])], kind)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 4 and {r["n"] for r in got} == {3}
    assert all(r["deviation"] is None for r in got)  # beyond 64 bits
    huge = whitening.whiten(spark.createDataFrame([(i, [float(i), -1e6 * i]) for i in range(9)], kind)).collect()
    s = sum(range(9))
    want = {i: (9 * 64 * i - 64 * s) ** 2 + (9 * 64_000_000 * i - 64_000_000 * s) ** 2 for i in range(9)}
    assert {r["vec_id"]: r["deviation"] for r in huge} == want


def test_products_are_exact():
    rnd = np.random.default_rng(5)
    for most in (3, 1 << 20, 1 << 40):
        y = rnd.integers(-most, most, (50, 4))
        assert (whitening.products(y) == y.astype(object).T @ y.astype(object)).all()
