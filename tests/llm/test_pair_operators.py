"""Substring de-duplication and the Jaccard join, against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardlake.llm import jaccard_tiles as JT
from cardlake.llm import substring_dedup as SD
from cardlake.llm.components import components
from cardlake.llm.tables import table
from cardlake.llm.words import quick_word_hashes

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(spark, pairs):
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    return df.selectExpr("*", "'x' AS chunk", "'x' AS digest", "1 AS n", "'q' AS text_key", "2 AS component")


def family(seed=1, members=40):
    """Near copies: one text with a word changed here and there, some in other letter case."""
    r = random.Random(seed)
    words = [f"w{r.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(members):
        mine = list(words)
        for _ in range(r.randrange(0, 4)):
            mine[r.randrange(len(mine))] = f"z{r.randrange(1000)}"
        out.append(" ".join(mine).upper() if i % 5 == 0 else "  ".join(mine))
    return out


def data(spark):
    texts = ODD_TEXTS + family() + ["passage " + " ".join(f"p{i}" for i in range(60)) + f" tail{k} " * 30 for k in range(30)]
    texts += [r.text for r in table(spark, SF, "documents").collect()]
    return [(i, t) for i, t in enumerate(texts)]


def brute_dedup(pairs, width=13):
    first, out = {}, []
    words = [WORD.findall(t or "") for _, t in pairs]
    for (i, _), w in zip(pairs, words):
        for k in range(len(w) - width + 1):
            g = tuple(w[k: k + width])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    for (i, _), w in zip(pairs, words):
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k: k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_substring_dedup_equals_brute_force(spark):
    pairs = data(spark)
    # null ids neither lose nor take; a repeated id is not smaller than itself
    pairs += [(None, pairs[12][1]), (None, pairs[12][1]), (12, pairs[12][1]), (5000, pairs[13][1] + " more words")]
    got = SD.substring_dedup(rows(spark, pairs)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_dedup(pairs)
    digests = SD.substring_dedup(rows(spark, pairs), output="sha256").select("kept_sha256").collect()
    assert sorted(r[0] for r in digests) == sorted(hashlib.sha256(x[3].encode()).hexdigest() for x in brute_dedup(pairs))


def test_quick_word_hashes_tell_words_apart():
    r = random.Random(2)
    words = {bytes(r.choice(b"ab\x00\xff") for _ in range(n)) for n in [*range(1, 140), 1000, 300_000] for _ in range(20)}
    words |= {w + b"\x00" for w in words}
    words = sorted(words)
    seen = {}
    for _ in range(2):  # at other places each time
        r.shuffle(words)
        raw = b" ".join(words)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
        ends = starts + np.array([len(w) for w in words])
        for w, h in zip(words, quick_word_hashes(raw, starts, ends).tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(words)


def test_chunk_equals_one_document_at_a_time():
    """Hashes of documents taken together are those of each alone, at every blank and length, over several stretches."""
    r = random.Random(5)
    texts = [None, "", " ", "one", "a b\tc\n\x0bd"] + family(3, 30) + [
        r.choice(["", " ", "\n\n"]).join(r.choice(["é\u00a0x ", "w%d\t" % r.randrange(40), " \r\n", "z" * 40 + " "])
                                        for _ in range(r.choice([0, 5, 12, 13, 14, 400, 30_000]))) for _ in range(60)]
    ids = [None if i % 17 == 3 else i for i in range(len(texts))]
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    c = SD.Chunk(table, 13, 3)
    seen = {}
    for n, (doc_id, text) in enumerate(zip(ids, texts)):
        words = WORD.findall(text or "")
        assert c.raw[n].decode() == " ".join(words) and c.n_words[n] == len(words)
        alone = SD.Chunk(table.slice(n, 1), 13, 3).hashes
        assert len(alone) == (max(0, len(words) - 12) if doc_id is not None else 0)
        assert c.hashes[c.edges[n]: c.edges[n + 1]].tolist() == alone.tolist()
        for h in alone.tolist():
            seen.setdefault(h, set()).add(n)
    assert c._in_two_documents().tolist() == [len(seen[h]) > 1 for h in c.hashes.tolist()]
    some = np.unique(c.hashes)[::7]
    assert SD._member(some, c.hashes).tolist() == np.isin(c.hashes, some).tolist()


def test_sketch_never_undercounts():
    rng = np.random.default_rng(3)
    parts = [np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint32)) for _ in range(5)]
    parts.append(parts[0][:100].copy())
    marks = SD.merge_sketches(parts)
    everything = np.concatenate(parts)
    values, n = np.unique(everything, return_counts=True)
    repeated = set(values[n > 1].tolist())
    for p, m in zip(parts, marks):
        assert repeated & set(p.tolist()) <= set(p[m].tolist())
    assert sum(m.sum() for m in marks) < len(everything) / 3


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_join(pairs):
    sets = {i: shingle_set(t) for i, t in pairs}
    parent = {i: i for i in sets}
    links = dict.fromkeys(sets, 0)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            A, B = sets[a], sets[b]
            if A and B and 5 * min(len(A), len(B)) >= 4 * max(len(A), len(B)):
                both = len(A & B)
                if 100 * both >= 80 * (len(A) + len(B) - both):
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


@pytest.mark.parametrize("block", [512, 4])
def test_jaccard_join_equals_brute_force(spark, block):
    pairs = data(spark)
    got = JT.jaccard_join(rows(spark, pairs), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got} == brute_join(pairs)


def test_jaccard_join_odd_ids_and_keep_one(spark):
    t = family(2, 3)
    pairs = [(7, t[1]), (7, t[1]), (9, t[1] + " end"), (None, t[1]), (3, None), (4, ""), (20, "far other text of words"),
             (7, "yet another text under the same id")]
    got = JT.jaccard_join(rows(spark, pairs)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.n_links) for r in got) == [
        (0, 0, 0), (3, 3, 0), (4, 4, 0), (7, 7, 0), (7, 7, 2), (7, 7, 2), (9, 7, 2), (20, 20, 0)]
    docs = rows(spark, pairs)
    kept = JT.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(7, t[1]), (0, t[1]), (3, ""), (4, ""), (20, pairs[6][1]), (7, pairs[7][1])])


def test_one_id_over_many_texts_brings_one_text_a_class(spark):
    texts = sorted(set(family(3, 30)))
    docs = spark.createDataFrame([(-1, t) for t in texts], "doc_id long, text string").withColumn(
        "text_key", F.xxhash64("text"))
    members = docs.select(F.col("doc_id").alias("rep"), F.col("text_key").alias("rep_key"), F.col("text").alias("digest"))
    got = JT.class_texts(docs, members).collect()
    assert sorted(r.text for r in got) == sorted(texts) and all(r.text == r.digest for r in got)
    links = JT.jaccard_join(docs).collect()
    want = brute_join(list(enumerate(texts)))
    assert sorted((r.n_shingles, r.n_links) for r in links) == sorted((n, k) for n, _, k in want.values())


def test_words_of_equal_polynomials_are_not_one(spark):
    """Two words whose hashes agree under every polynomial modulo 2**64 with an odd base."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    texts = [f"one two three four {w} five six" for w in (a, b)]
    got = JT.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.n_links) for r in got} == {(0, 0, 0), (1, 1, 0)}


def test_very_long_texts_are_cut_by_their_shingles(spark, monkeypatch):
    """Near copies of a long text meet although a block holds the shingles of one of them only."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    texts = []
    for i in range(12):
        w = list(words)
        for _ in range(100):
            w[rng.randrange(len(w))] = f"x{i}"
        texts.append(" ".join(w))
    monkeypatch.setattr(JT, "BLOCK_SHINGLES", 20_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_links) for r in JT.jaccard_join(df).collect()}
    assert got == {i: (0, 11) for i in range(12)}


def test_bitmap_bound_never_misses():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 63, int(rng.integers(3, 300)), dtype=np.uint64)
        for _ in range(4):
            keep = base[rng.random(len(base)) > 0.08]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, 3, dtype=np.uint64)])))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    maps = [JT.bitmap(s, JT.bitmap_width(len(s))) for s in sets]
    passed = {(i, j) for i, js in JT.passing(n, maps, 80) for j in js.tolist()}
    true = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert true <= passed and len(passed) < 4 * len(true)
    exact = {(i, j) for i, js in JT.linked(sets, n, maps, np.full(len(n), -1), 80) for j in js.tolist()}
    assert exact == true


@pytest.mark.parametrize("sizes", [[10] * 4 + [100] * 5, [5, 9, 9, 9, 30, 31, 32, 90, 400], [7] * 11, list(range(1, 40))])
@pytest.mark.parametrize("block", [2, 3, 4])
def test_all_sizes_in_reach_meet(sizes, block):
    n = np.array(sizes)
    tiles = [set(m.tolist()) for m in JT.meetings(n, 80, block)]
    assert all(len(t) <= 2 * block for t in tiles)
    for i in range(len(n)):
        for j in range(i + 1, len(n)):
            if 100 * n[i] >= 80 * n[j]:
                assert any(i in t and j in t for t in tiles), (i, j)


def posted_lists(seed):
    """Rows (shingle, sid, n, spread): lists of 1 to 60 classes, two lists equal, rows repeated."""
    r = random.Random(seed)
    size = {sid: r.randrange(10, 40) for sid in range(-40, 60)}
    lists = {k: r.sample(sorted(size), r.choice([1, 2, 7, 8, 9, 30, 60])) for k in range(-20, 20)}
    lists[99] = lists[98] = sorted(size)
    return size, lists, [(k, x, size[x], (1 + x % 3) * (k % 5 == 0)) for k, v in lists.items() for x in v + v[:3]]


def test_long_lists_are_cut_on_spark(spark, monkeypatch):
    size, lists, posted = posted_lists(6)
    monkeypatch.setattr(JT, "meetings", None)
    got = {}
    for t, sid in JT.tiles(spark.createDataFrame(posted, "shingle long, sid long, n long, spread long"), 80, 3, 4).collect():
        got.setdefault(t, []).append(sid)
    assert all(2 <= len(t) <= 8 and len(set(t)) == len(t) for t in got.values())
    assert len({frozenset(t) for t in got.values()}) == len(got)
    met = {(a, b) for t in got.values() for a in t for b in t}
    for v in lists.values():
        assert all((a, b) in met for a in v for b in v if a != b and 100 * size[a] >= 80 * size[b] >= 80 * size[a])
    together = {(a, b) for v in lists.values() for a in v for b in v}
    assert met <= together


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_a_long_list_is_never_held(monkeypatch, chunk):
    import pyarrow as pa

    monkeypatch.setattr(JT, "_CHUNK_ROWS", chunk)
    _, lists, posted = posted_lists(7)
    cols = list(zip(*sorted((s, spread, x, n) for s, x, n, spread in posted)))
    table_ = pa.table(dict(zip(("shingle", "spread", "sid", "n"), map(list, cols))))
    out = list(JT.read_lists(iter(table_.to_batches(max_chunksize=3)), 8))
    assert chunk == 1000 or max(b.num_rows for b in out) <= 8 + chunk + 3
    rows_ = [tuple(r.values()) for b in out for r in b.to_pylist()]
    dealt = {k for k in lists if k % 5 == 0}
    assert sorted((s, x) for t, s, x, _ in rows_ if t is None) == sorted(
        (k, x) for k, v in lists.items() if len(v) > 8 or k in dealt for x in v)
    short = {}
    for t, _, x, _ in rows_:
        short.setdefault(t, set()).add(x)
    short.pop(None)
    assert {frozenset(t) for t in short.values()} == {
        frozenset(v) for k, v in lists.items() if 1 < len(v) <= 8 and k not in dealt}


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    df = spark.createDataFrame(edges + edges[:5], "a long, b long")
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    got = {x.node: x.component for x in components(df).collect()}
    assert got == {i: find(i) for e in edges for i in e if e[0] != e[1]}
    assert components(df.where("a < 0")).count() == 0


@pytest.mark.parametrize("op", [SD.substring_dedup, JT.jaccard_join, JT.keep_one_per_group])
def test_empty_table(spark, op):
    assert op(rows(spark, [(1, "x")]).where(F.lit(False))).collect() == []
