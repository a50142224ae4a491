"""Every operator against a plain computation, on odd rows and on an empty table."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from syncforge.llm import bpe, buffers, decontam, html, importance, jaccard, licenses, quality, sharding, suffix, tokenfile


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def code_words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def some_texts(seed, n=40):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["é", "the"]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([4, 30, 80]))] for _ in range(8)]
    out = []
    for _ in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 9])):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def many(spark, docs):
    extra = spark.createDataFrame(list(enumerate(some_texts(1), 100)), "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(extra)


# sharding


def test_shards_keep_groups_and_balance(docs, many):
    for df in (docs, many):
        rows = sharding.shard(df, shards=4, buckets=3, salts=5).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows) == sorted((k is None, k or 0, len((t or "").encode()) + 1) for k, t in pairs(df))
        for s, own in Counter(r["shard"] for r in rows).items():
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(own))
    by_text = defaultdict(set)
    crc = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in sharding.shard(many).collect()}
    for k, t in pairs(many):
        by_text[t].add(crc[k, zlib.crc32((t or "").encode())])
    assert all(len(s) == 1 for s in by_text.values())
    again = {(r["doc_id"], r["text_crc32"]): r["shard"] for r in sharding.shard(many.repartition(7)).collect()}
    assert again == crc


def plain_shards(sizes, groups, shards, buckets):
    """The law by hand: in each bucket the largest group goes to the emptiest bin; then bins to shards by the same rule."""
    bins = {}
    for b in range(buckets):
        own = sorted((g for g in groups if groups[g] == b), key=lambda g: (-sizes[g], g))
        loads = [0] * shards
        for g in own:
            s = loads.index(min(loads))
            loads[s] += sizes[g]
            bins.setdefault((b, s), []).append(g)
    order = sorted(bins, key=lambda x: (-sum(sizes[g] for g in bins[x]), x))
    loads, out = [0] * shards, {}
    for x in order:
        s = loads.index(min(loads))
        loads[s] += sum(sizes[g] for g in bins[x])
        out |= {g: s for g in bins[x]}
    return out, loads


def test_shards_by_the_law(many):
    """Every group where the plain computation puts it; loads apart by no more than the largest group."""
    keyed = many.select("text", sharding.text_key(F.col("text")).alias("g")).withColumn("b", F.pmod(F.xxhash64("g"), F.lit(3)).cast("int")).collect()
    sizes = Counter()
    for r in keyed:
        sizes[bytes(r["g"])] += len((r["text"] or "").encode()) + 1
    want, loads = plain_shards(sizes, {bytes(r["g"]): r["b"] for r in keyed}, 4, 3)
    got = sharding.shard(many, shards=4, buckets=3, salts=5).collect()
    by_crc = {zlib.crc32((r["text"] or "").encode()): want[bytes(r["g"])] for r in keyed if r["text"]}
    assert all(r["shard"] == by_crc[r["text_crc32"]] for r in got if r["text_crc32"])
    own = Counter()
    for r in got:
        own[r["shard"]] += r["size"]
    assert sorted(own.values()) == sorted(x for x in loads if x)
    small = many.where("length(text) < 1000")
    even = Counter()
    for r in sharding.shard(small, shards=4, buckets=1).collect():
        even[r["shard"]] += r["size"]
    assert max(even.values()) - min(even.values()) <= max(len((t or "").encode()) + 1 for _, t in pairs(small))


def test_lpt_rule():
    assert list(sharding.lpt([7, 6, 5, 4, 3], 2)) == [0, 1, 1, 0, 0]


# quality


def test_ledger(docs):
    got = sorted(map(tuple, quality.ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=str)
    want = []
    for k, t in pairs(docs):
        words = re.findall("[^\x20\x09-\x0d]+", t or "")
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        hit = {i + j for i in range(len(words) - 4) for j in range(5) if grams[tuple(words[i : i + 5])] > 1}
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        want.append((k, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)))
    assert got == sorted(want, key=str)


def test_policies_and_ablation(many):
    entries = quality.ledger(many)
    for version, policy in quality.POLICIES.items():
        rows = quality.apply_policy(entries, version).collect()
        assert all(r["kept"] == ((r["fail_bits"] & policy.mask) == 0) for r in rows)
        assert not any(r["kept"] and r["base_failed"] for r in rows)
        for r in quality.ablate(entries, version).collect():
            bit = next(x.mask for x in quality.RULES if x.name == r["rule"])
            assert r["n_failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
            assert r["n_only"] == sum(x["fail_bits"] & policy.mask == bit for x in rows)


def test_keep_leaves_rows_as_they_are(docs):
    kept = quality.keep(docs)
    assert kept.schema == docs.schema
    # the text's own verdict, also where keys repeat
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t in pairs(docs) if t and t.startswith("The same"))


# licences


def test_licences(spark, docs):
    texts = ["Released under the MIT License.", "x Under-the MIT/license, CC BY-NC 4.0 cc by nc", "Apache License, Version 2.0; apache license version two", "under the mit", "All Rights Reserved", "under the mit license " * 3]
    texts += ["cc by nc sa 4.0 and again CC-BY-NC-SA 4.0", "GNU Lesser General Public License, version 3", "version 3 of the gnu general public license", "nc by cc", " ".join(t.text for t in licenses.TEMPLATES)]
    df = docs.unionByName(spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string"), allowMissingColumns=True)
    df = df.withColumns({"words": df["text"], "found": df["text"]})  # clashing names
    got = sorted(map(tuple, licenses.scan(df).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=str)
    want = []
    for k, t in pairs(df):
        w = code_words(t)
        at = [(i, x.label) for x in licenses.TEMPLATES if x.base for i in range(len(w)) if w[i : i + len(x.key_words)] == x.key_words]
        want.append((k, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    assert got == sorted(want, key=str)
    score = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(df).where("doc_id >= 100").collect()}
    for i, t in enumerate(texts, 100):  # all labels, over all templates and places
        w = code_words(t)
        own = [(x, j - x.key_at) for x in licenses.TEMPLATES for j in range(len(w)) if w[j : j + len(x.key_words)] == x.key_words]
        best = max((sum(0 <= s + j < len(w) and w[s + j] == y for j, y in enumerate(x.words)) / len(x.words) for x, s in own), default=0.0)
        assert score[i] == (",".join(sorted({x.label for x, _ in own})), pytest.approx(best))
    assert len(licenses.TEMPLATES) > 130
    assert score[100] == ("mit", 1.0) and score[104] == ("all-rights-reserved", 1.0) and score[103] == ("", 0.0)


# byte-level BPE


def test_bpe_round_trip(spark, docs, many):
    tiktoken = pytest.importorskip("tiktoken")
    lines = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (docs, many):
        rows = bpe.encode(df, lines, P.PATTERN, ("ids", "decoded", "ids_sha256")).collect()
        want = sorted((own.encode_ordinary(t or ""), (t or "").encode()) for _, t in pairs(df))
        assert sorted((r["ids"], bytes(r["decoded"])) for r in rows) == want
        assert all(r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() for r in rows)


def test_bpe_columns_of_one_name(docs):
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumn("ids", F.lit(1)), [], P.PATTERN, ("ids",), also=("ids",))


def test_bpe_cache_restarts():
    lines = open(P.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    codec = bpe.Codec(lines, P.PATTERN)
    codec.blocks.limit = 40
    texts = some_texts(5, 60)
    for part in (texts[:30], texts[30:], texts):
        data, offs = buffers.flat(pa.array(part))
        ids, at = codec.encode(data, offs)
        fresh, same = bpe.Codec(lines, P.PATTERN).encode(data, offs)
        assert (ids == fresh).all() and (at == same).all()
        assert codec.decode(ids, at)[0].tobytes() == data.tobytes()


# suffix-array dedup


def test_suffix_against_all_windows(spark):
    rnd = random.Random(4)
    piece = ["".join(rnd.choice("ab cé") for _ in range(rnd.randint(5, 60))) for _ in range(6)]
    texts = ["".join(rnd.choice(piece) for _ in range(rnd.randint(0, 8))) for _ in range(30)] + ["ab" * 60, None, "", "ab" * 60]
    rows = list(enumerate(texts)) + [(2, "another of key two " * 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs_ = sorted((k, (t or "").encode()) for k, t in rows)
    length = 20
    for single in (True, False):
        use = [(k, b) for k, b in docs_ if not single or not (k == 2 and b.startswith(b"another"))]
        part = df if not single else df.where("not (doc_id = 2 and text like 'another%')")
        got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.digests(part, length=length).collect()}
        if not single:  # two texts of one key: each row is answered
            assert len(got) == len({(k, len(b)) for k, b in use})
            continue
        seen: set[bytes] = set()
        for k, b in use:
            gone = np.zeros(len(b), bool)
            for i in range(len(b) - length + 1):
                w = b[i : i + length]
                if w in seen:
                    gone[i : i + length] = True
                seen.add(w)
            edge = np.diff(np.concatenate([[0], gone.astype(int)]))
            kept = bytes(np.frombuffer(b, np.uint8)[~gone])
            assert got[k, len(b)] == (int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest())


def removed_by_windows(docs_, length):
    """Per key: removed bytes, spans and digest of the rest, over all windows in order of the documents."""
    seen, out = set(), {}
    for k, b in docs_:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(b[i : i + length])
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[k] = int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()
    return out


@pytest.mark.parametrize("held", [suffix.HELD_BYTES, 2000])
def test_suffix_table_of_one_third_dashes(spark, monkeypatch, held):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 20_000)
    rnd = random.Random(8)
    words = [f"w{rnd.random():.9f}" for _ in range(3000)]
    rows = []
    for i in range(60):
        prose = [" ".join(rnd.choices(words, k=30)) for _ in range(3)]
        rule = rnd.choice(["-", "-", " ", "-=", "0"]) * rnd.choice([20, 80, 130, 400, 900])
        rows.append((i, rule.join(prose) if i % 3 else "-" * 3000))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    if held != suffix.HELD_BYTES:  # the bucket reduced while read, in this process
        batch = pa.table({"key": [k for k, _ in rows], "row": [0] * len(rows), "text": [t for _, t in rows]}).to_batches()[0]
        sent = [x for b in suffix._sent(1, 100, 16)([batch]) for x in b.to_pylist()]
        monkeypatch.setattr(suffix, "HELD_BYTES", held)
        gone = defaultdict(list)
        table = pa.Table.from_pylist(sent, pa.schema([("bucket", pa.int64()), ("payload", pa.binary()), ("bytes", pa.binary())])).sort_by("bucket")
        for b in suffix._bucket_ranges(100, 16)(table.combine_chunks().to_batches()):
            for r in b.to_pylist():
                gone[r["key"]].append(np.frombuffer(r["gone"], "<u4").reshape(-1, 2))
        want = removed_by_windows([(k, t.encode()) for k, t in rows], 100)
        for k, t in rows:
            pairs_ = np.concatenate(gone[k]).astype(np.int64) if k in gone else np.zeros((0, 2), np.int64)
            assert int(buffers.covered(len(t), pairs_[:, 0], pairs_[:, 1]).sum()) == want[k][0]
        return
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.digests(df).collect()}
    assert got == removed_by_windows([(k, t.encode()) for k, t in rows], 100)


def test_suffix_run_of_one_byte_is_one_place():
    batch = pa.table({"key": [1, 2, 3], "row": [0, 0, 0], "text": ["-" * 3000, "-" * 5000, " " * 3000]}).to_batches()[0]
    sent = [r for b in suffix._sent(1, 100, 16)([batch]) for r in b.to_pylist()]
    assert sum(len(suffix._unpacked(r["payload"])[0]) for r in sent if r["bucket"] >= 0) == 2
    # a rule before differing lines does not send all of them to one minimizer
    rnd = random.Random(2)
    lines = ["-" * 80 + "".join(rnd.choices("abcdefgh", k=400)) for _ in range(50)]
    data, offs = buffers.flat(pa.array(lines))
    start, _, low, _, _ = suffix.runs(data, offs, 100, 16, suffix._powers(suffix.STRETCH + 100))
    assert np.unique(low, return_counts=True)[1].max() <= 2 * len(lines)


def test_suffix_cut_keeps_columns_and_whole_characters(docs):
    out = suffix.cut(docs, length=12)
    assert out.schema == docs.schema
    left = pairs(out)
    assert (0, None) in left and (1, "") in left
    assert sum(t == "The same text twice, with some more words to fill a window of ten." for _, t in left) == 1


def test_suffix_null_keys_come_first(spark):
    rnd = random.Random(8)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(150))
    df = spark.createDataFrame([(1, text), (None, "x" + text), (None, "x" + text), (5, "y" + text)], "doc_id long, text string")
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in suffix.digests(df).collect())
    assert got == [(False, 0, 0), (False, 0, 0), (True, 1, 150), (True, 5, 150)]


# near duplicates


def brute_classes(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").split(" ") if False else re.findall("[^\x20\x09-\x0d]+", t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) * 5 >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[find(i)].append(k)
    return [(k, k if not s else min((x for x in least[find(i)] if x is not None), default=None), links[i]) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize("block", [1024, 5])
def test_near_duplicates(spark, many, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    long = " ".join(f"v{i}" for i in range(60))
    nulls = [(None, long), (7, long), (8, long + " one"), (9, long + " two"), (None, long + " three"), (None, "alone " * 3), (None, "alone " * 3)]
    df = many.unionByName(spark.createDataFrame(nulls, "doc_id long, text string"))
    got = sorted(map(tuple, jaccard.classes(df).select("doc_id", "class_id", "n_links").collect()), key=str)
    assert got == sorted(brute_classes(pairs(df)), key=str)
    assert [r["doc_id"] for r in jaccard.one_of_each(spark.createDataFrame(nulls[:5], "doc_id long, text string")).collect()] == [7]


def test_one_of_each(docs, many):
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    texts = Counter(t for _, t in pairs(left))
    assert texts["The same text twice, with some more words to fill a window of ten."] == 1 and texts["one"] == 1 and texts[None] == 1
    rows = pairs(many.where("doc_id >= 100"))
    assert sorted(k for k, _ in pairs(jaccard.one_of_each(many.where("doc_id >= 100")))) == sorted({c for _, c, _ in brute_classes(rows)})


# token files


def test_token_files(spark, docs, many):
    from tokenizers import Tokenizer

    vocabulary = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
    hf = Tokenizer.from_str(vocabulary)
    big = [(None, "a"), ((1 << 53) + 1, "b <|endoftext|> c"), ((1 << 53) + 3, "<|endoftext|>"), (-(1 << 63), "d"), (None, "<|endof"), (1 << 62, "text|>")]
    assert hf.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    for df in (docs, many, spark.createDataFrame(big, "doc_id long, text string")):
        table = tokenfile.write(df, vocabulary, tokenfile.fresh_path(spark), part_bytes=20_000)
        got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read_documents(table).collect()), key=str)
        want, at = [], 0
        for k, t in sorted(pairs(df), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
            ids = [*hf.encode(t or "", add_special_tokens=False).ids, 0]
            want.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert got == sorted(want, key=str)


def test_pfor_blocks():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        for ids in (rnd.integers(0, 1 << 32, n, np.uint64).astype(np.uint32), np.where(rnd.random(n) < 0.03, 1 << 31, rnd.integers(7, 40, n)).astype(np.uint32), np.full(n, 9, np.uint32)):
            image = tokenfile.Image(tokenfile.write_image(np.array([5]), np.array([n]), ids))
            assert (image.ids(0, n) == ids).all() and (image.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    small = tokenfile.write_image(np.array([1]), np.array([4096]), rnd.integers(1000, 1016, 4096).astype(np.uint32))
    assert len(small) < 4096  # four bits an id and the exceptions


# HTML


def test_main_text():
    weights = html.Weights.of(html.count(["<body><nav><ul><li><a>Home</a></ul></nav><article><h1>T</h1><p>some words of text</p></article><footer>foot</footer>"] * 5))
    page = """<html><head><title>no</title><script>var a="</p>";</script></head><body><header>Site</header><div class="ad">buy this</div>
    <main><h1>Ti&amp;tle</h1><p>First <b>para</b>graph&nbsp;of
    the text.<p>Second one<br>here.<aside>not this</aside><p>Third &lt;one&gt;.<div id=comments><p>me too</div></main><footer>&copy;</footer></body>"""
    assert html.main_text(page, weights) == "Ti&tle\nFirst paragraph of the text.\nSecond one here.\nThird <one>."
    for empty in (None, "", "<p", "<script>x", "<!-- a", "<nav>menu here</nav>"):
        assert html.main_text(empty, weights) == ""
    assert html.main_text("just text", weights) == "just text"
    assert len(html.main_text("<p>" + "word " * 100_000, weights)) == 499_999


@pytest.mark.parametrize("opening", ["div class='content has-sidebar'", "main class='with-nav'", "article class='post comments-open'", "div id=search-page role=main", "div class='has-sidebar'><article"])
def test_names_of_containers_are_no_proof(opening):
    weights = html.Weights.of(html.count(["<body><nav><ul><li><a>Home</a></ul></nav><article><h1>T</h1><p>some words of text</p></article><div class=ad>ad</div><footer>foot</footer>"] * 5))
    body = "<h1>Head</h1><p>one paragraph of the text<div class='social share'>tell others</div><p>and another paragraph of it"
    page = f"<body><div class=ad>buy this</div><{opening}>{body}</{opening.split()[0]}><div class=sidebar><p>see also</p></div><footer>foot</footer>"
    assert html.main_text(page, weights) == "Head\none paragraph of the text\nand another paragraph of it"


LABELLED = ["<body><nav><ul><li><a>Home</a></ul></nav><article><h1>T</h1><p>some words of text and more of them</p></article><div class=ad>ad</div><footer>foot</footer>"] * 5
LONG = "comment " * 60
ARTICLE = "<article><h1>Head</h1><p>one paragraph of the text</p><p>and another paragraph of it</p></article>"
TEXT = "Head\none paragraph of the text\nand another paragraph of it"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"{ARTICLE}<section id=comments><h2>Comments</h2><p>{LONG}</p></section>", TEXT),
        (f"<main>{ARTICLE}<div class=comments><p>{LONG}</p><article class=comment><p>{LONG}</p></article></div></main>", TEXT),
        (f"<div class=post>{ARTICLE}<div class='reader-comments'><article><p>{LONG}</p></article></div></div>", TEXT),
        (f"{ARTICLE}<div class=related><h3>More</h3><p>{LONG}</p></div>", TEXT),
        (f"{ARTICLE}<div class=ad>buy this</div>{ARTICLE}", f"{TEXT}\n{TEXT}"),
        (f"<div class=notice><p>{LONG}</p></div>{ARTICLE}", TEXT),
        (ARTICLE.replace("<h1>", "<h1 class=alert>").replace("</p><p>", "</p><h2 class=alert>Mind this</h2><p>"), TEXT.replace("\nand", "\nMind this\nand")),
        (f"<form id=page action=x><div class='sidebar-left'>{ARTICLE}</div><input></form>", TEXT),
    ],
)
def test_layouts(page, text):
    assert html.main_text(f"<body><nav><a>menu</a></nav>{page}<footer>foot</footer>", html.Weights.of(html.count(LABELLED))) == text


def test_region_is_the_best_of_all():
    rnd = random.Random(6)
    for _ in range(400):
        n = rnd.randint(0, 9)
        scores, gaps = [rnd.choice([-3, -1, 1, 2, 5]) for _ in range(n)], [-rnd.choice([0.25, 1, 4]) for _ in range(n)]
        sums = {(a, e): sum(scores[a:e]) + sum(gaps[a + 1 : e]) for a in range(n) for e in range(a + 1, n + 1)}
        best = max(sums.values(), default=0)
        want = min((r for r, x in sums.items() if x == best), key=lambda r: (r[1], -r[0]), default=(0, 0)) if best > 0 else (0, 0)
        assert html.best_region(scores, gaps) == want


def test_the_scan_decides():
    """Links before the article score below zero and go; links inside it are bridged and stay."""
    weights = html.Weights.of(html.count(LABELLED))
    links = "<ul><li><a>one</a></li><li><a>two</a></li></ul>"
    page = f"<body>{links}<p>{'word ' * 80}</p>{links}<p>{'text ' * 80}</p>{links}</body>"
    blocks = html.blocks_of(page)
    scores = [weights.of_block(b) for b in blocks]
    got = html.main_text(page, weights).split("\n")
    assert [b.text for b in blocks[2:6]] == got and len(blocks) == 8
    assert [b.text for b, s in zip(blocks, scores, strict=True) if s > 0] != got  # a filter on blocks gives other text


def test_extract_table(spark):
    page = "<body><nav><a href=x>menu item</a></nav><article><h1>Head</h1><p>{}</p></article><footer>foot</footer>"
    rows = [(i, f"u{i}", page.format(f"text number {i} of a page"), "x") for i in range(20)] + [(20, None, None, None), (20, "u", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html.extract(df).collect()}
    assert got[3, "u3"] == ("Head\ntext number 3 of a page", 28) and got[20, None] == ("", 0) and got[20, "u"] == ("", 0)


# importance resampling


def test_importance(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        vocab = ["alpha", "beta", "gamma", "delta"] if good else ["junk", "spam", "buy"]
        rows.append((i, " ".join(rnd.choice(vocab) for _ in range(30))))
        if i < 200:
            labels.append((i, int(good), 0))
    rows += [(1000, None), (1001, ""), (1001, "")]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = importance.sample(df, lab, k=250).collect()
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == 250
    best = sorted(got, key=lambda r: -r["score"])[:250]
    assert {r["doc_id"] for r in best} == {r["doc_id"] for r in got if r["kept"]}
    held_out = [r for r in got if 200 <= r["doc_id"] < 400 and r["kept"]]
    assert sum(r["doc_id"] % 4 != 0 for r in held_out) / len(held_out) > 0.95
    assert sum(r["kept"] for r in importance.sample(df, lab.where("false")).collect()) == len(rows)


def test_importance_share_and_weight_of_the_method(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None)], "doc_id long, quality int, toxic int")
    assert importance.label_share(labels) == 0.5
    df = spark.createDataFrame([(1, "alpha beta"), (2, "junk spam"), (3, "junk buy"), (4, "alpha"), (5, "alpha beta alpha beta"), (6, "")], "doc_id long, text string")
    ratio = importance.fit(df, labels)
    got = {r["doc_id"]: r["log_weight"] for r in importance.sample(df, labels).collect()}
    for r in df.collect():
        own, _ = importance.features(*buffers.flat(pa.array([r["text"]])))
        assert got[r["doc_id"]] == pytest.approx(ratio[own].sum(), abs=1e-6)


def test_importance_against_a_plain_model(spark):
    """Counts, smoothed models, log ratios and the k greatest by hand; ties over the k-th place, null and repeated keys, clashing names."""
    rows = [(1, "alpha beta gamma"), (2, "junk spam"), (3, "junk buy now"), (4, "alpha beta"), (None, "alpha beta gamma"), (7, "alpha beta"), (7, "alpha beta"), (8, None), (9, "")]
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], "doc_id long, text string, row long, rank string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    feats = {t: importance.features(*buffers.flat(pa.array([t])))[0].tolist() for _, t in rows if t}
    raw, target = Counter(), Counter()
    for _, t in rows:
        raw.update(feats.get(t, []))
    for k, t in rows:
        if k in (1, 4):
            target.update(feats.get(t, []))

    def log_share(c, f):
        return np.log((c[f] + importance.SMOOTH) / (sum(c.values()) + importance.FEATURES * importance.SMOOTH))

    for k in range(len(rows) + 1):  # the k greatest; equal rows share their fate
        got = importance.sample(df, labels, k=k).collect()
        kept, gone = ([r["score"] for r in got if r["kept"] is x] for x in (True, False))
        assert len(got) == len(rows) and k <= len(kept) <= k + 1 and min(kept, default=9e9) >= max(gone, default=-9e9)
        assert len({r["kept"] for r in got if r["doc_id"] == 7}) == 1
        assert len(kept) == k or any(r["kept"] for r in got if r["doc_id"] == 7)
    want = sorted((str(k), round(float(sum(log_share(target, f) - log_share(raw, f) for f in feats.get(t, []))), 5)) for k, t in rows)
    assert sorted((str(r["doc_id"]), round(r["log_weight"], 5)) for r in got) == want
    weight = {r["doc_id"]: r["log_weight"] for r in got}
    assert weight[4] > weight[2] and weight[None] == weight[1] and weight[8] == weight[9] == 0


# decontamination


def test_benchmark_windows(docs, many, spark):
    items = [(1, "with some more words to fill a window of ten. and more words after that"), (2, "one"), (3, None), (4, " ,. "), (5, "w1 w2"), (5, "A b, C d"), (7, "the same TEXT twice with some more words to fill a window")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    phrases = {}
    for k, t in items:
        w = code_words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            phrases.setdefault(tuple(w[i : i + 10]), set()).add(str(k))
    for df, size in ((docs, decontam.BLOCK_WORDS), (many, decontam.BLOCK_WORDS), (many, 8)):
        got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.find(df, bench, block_words=size).collect()), key=str)
        want = []
        for k, t in pairs(df):
            w, hit, own = code_words(t), set(), set()
            for p, keys in phrases.items():
                for i in range(len(w) - len(p) + 1):
                    if tuple(w[i : i + len(p)]) == p:
                        hit |= set(range(i, i + len(p)))
                        own |= keys
            want.append((k, len(w), len(hit), tuple(sorted(own))))
        assert got == sorted(want, key=str)
    cut = decontam.cut(docs, bench)
    assert cut.schema == docs.schema
    assert not any(r["n_hit"] for r in decontam.find(cut, bench).collect())
    assert (0, None) in pairs(cut) and (1, "") in pairs(cut) and not any(t == "one" for _, t in pairs(cut))


def test_fm_index_locates():
    rnd = np.random.default_rng(2)
    text = rnd.integers(1, 4, 400)
    text[rnd.integers(0, 400, 12)] = 0
    text[-1] = 0
    index = decontam.FmIndex(text, 4)
    rows = np.array([[0, 1, 2], [1, 1, 1], [3, 2, 1]])
    size = np.array([2, 3, 3])
    lo, hi = index.search(rows, size)
    for p, n, a, b in zip(rows, size, lo, hi, strict=True):
        want = [i for i in range(400 - n + 1) if (text[i : i + n] == p[3 - n :]).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


# empty tables


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    lines = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vocabulary = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
    for df in (
        sharding.shard(none),
        quality.apply_policy(quality.ledger(none)),
        quality.keep(none),
        quality.ablate(quality.ledger(none)),
        licenses.scan(none),
        bpe.encode(none, lines, P.PATTERN),
        suffix.digests(none),
        suffix.cut(none),
        jaccard.classes(none),
        jaccard.one_of_each(none),
        tokenfile.read_documents(tokenfile.write(none, vocabulary, tokenfile.fresh_path(spark))),
        importance.sample(none, labels),
        decontam.find(none, bench),
        decontam.cut(none, bench),
        html.extract(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html"))),
    ):
        assert df.count() == 0
    assert decontam.find(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")), bench.where("false")).first()["n_hit"] == 0


# hashes


def thue_morse(n):
    """A word of n letters and its complement: alike for hashes that are polynomials modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_collide_by_their_structure(spark, n):
    tiktoken = pytest.importorskip("tiktoken")
    one, two = thue_morse(n)
    data = np.frombuffer((one + two).encode(), np.uint8)
    h = buffers.span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
    assert h[0] != h[1]
    texts = [one, two, f"{one}\n{two}", f"w {one} x y z w {two} x y z", f"a b c d {one}", f"a b c d {two}", f"bench {two}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = bpe.vocabulary(spark, P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={})
    got = {r["doc_id"]: r for r in bpe.encode(df, lines, P.PATTERN, ("ids", "decoded")).collect()}
    assert all(got[i]["ids"] == own.encode_ordinary(t) and bytes(got[i]["decoded"]).decode() == t for i, t in enumerate(texts))
    measured = {r["doc_id"]: r for r in quality.ledger(df).collect()}
    assert measured[2]["n_dup_lines"] == 0 and measured[3]["n_repeat_words"] == 0
    assert sorted(map(tuple, jaccard.classes(df).select("doc_id", "class_id", "n_links").collect())) == sorted(brute_classes(list(enumerate(texts))))
    bench = spark.createDataFrame([(1, f"bench {one}")], "item_id long, text string")
    assert not any(r["n_hit"] for r in decontam.find(df, bench).collect())
    removed = {r["doc_id"]: r["n_removed"] for r in suffix.digests(df, length=n).collect()}
    assert removed == {k: v[0] for k, v in removed_by_windows(list(enumerate(t.encode() for t in texts)), n).items()}


def test_equal_hashes_are_told_apart(monkeypatch):
    """Every hash the same: bytes decide."""
    monkeypatch.setattr(buffers, "_span_hashes", lambda data, starts, ends, seed: np.zeros(len(starts), np.uint64))
    texts = some_texts(7, 12) + ["x\ny\nx\n", "a a b b a a"]
    data, offs = buffers.flat(pa.array(texts))
    got = quality.measure(data, offs)
    for i, t in enumerate(texts):
        words = t.split()
        grams = Counter(tuple(words[j : j + 5]) for j in range(len(words) - 4))
        assert got["n_repeat_words"][i] == len({j + d for j in range(len(words) - 4) for d in range(5) if grams[tuple(words[j : j + 5])] > 1})
    assert got["n_dup_lines"].tolist() == [0] * 12 + [1, 0]
    lines = open(P.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    codec = bpe.Codec(lines, P.PATTERN)
    ids, at = codec.encode(data, offs)
    assert [ids[a:e].tolist() for a, e in zip(at[:-1], at[1:], strict=True)] == [codec.encode_texts([t]).tolist() for t in texts]
