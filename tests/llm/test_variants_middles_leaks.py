"""Spelling variants, fill-in-the-middle and decontamination against plain Python."""

import collections
import hashlib
import random
import re
import time
import tracemalloc
import zlib

import numpy as np

from cardlake.llm import decontamination as DC
from cardlake.llm import fill_in_middle as FM
from cardlake.llm import spelling_variants as SV
from cardlake.llm.fm_index import FMIndex
from cardlake.llm.queries import queries
from cardlake.llm.tables import table

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
# columns whose names the operators use themselves
SCHEMA = "doc_id long, text string, doc string, spans string, items long, word string, n long, hash long, form string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "d", "s", 1, "w", 2, 3, "f") for i, t in rows], SCHEMA)


def given(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]


# --- spelling variants ---------------------------------------------------------------

def variants(rows):
    n = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near, alike = collections.defaultdict(set), collections.defaultdict(list)
    for w in n:
        for i in range(len(w)):
            alike[w[:i], w[i + 1:]].append(w)
            if (d := w[:i] + w[i + 1:]) in n:
                near[w].add(d)
                near[d].add(w)
    for group in alike.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in SV.spelling_variants(df).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(2)
    rows = given(spark) + [(None, t) for t in ODD_TEXTS]
    rows += [(1000 + i, " ".join("".join(rng.choice("abÀ÷") for _ in range(rng.choice([5, 6, 7]))) for _ in range(300)))
             for i in range(30)]
    long = ["x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149]
    rows += [(5, " ".join(long))] * 3
    # counts 3, 6, 12, ... of words one letter apart: one chain of forms
    chain = ["q" * i + "z" * (12 - i) for i in range(12)]
    rows += [(7, " ".join(w for i, w in enumerate(chain) for _ in range(3 << i)))]
    want = variants(rows)
    got = found_variants(documents(spark, rows))
    assert got == want
    assert len({w for w in chain if got[w][1] == chain[-1]}) > 6


def test_variants_in_many_rounds(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(400))) for i in range(9)]
    want = variants(rows)
    monkeypatch.setattr(SV, "ROUND_BYTES", 64)
    assert found_variants(documents(spark, rows)) == want


def test_variants_behind_full_filters(spark, monkeypatch):
    """One block per length lets nearly every edit through: the exact join alone decides."""
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("abcdé") for _ in range(5)) for _ in range(300))) for i in range(9)]
    monkeypatch.setattr(SV, "WORDS_PER_BLOCK", 1 << 30)
    assert found_variants(documents(spark, rows)) == variants(rows)


def test_edit_hashes_are_those_of_the_edited_words():
    words = ["abcde", "aabbÀ", "abcdefg", "zzzzzz"]
    letters = SV.Letters(words)
    known = {}
    for i, w in enumerate(words):
        for at in range(len(w)):
            known[i, at, ""] = w[:at] + w[at + 1:]
            for c in map(chr, SV.LETTERS):
                known[i, at, c] = w[:at] + c + w[at + 1:]
    seen = collections.defaultdict(set)
    for edited, hashes, letter in letters.edits():
        for e, h in zip(edited.tolist(), hashes.tolist()):
            i = int(letters.word[e])
            word = known[i, int(letters.at[e]), letter]
            assert int(SV.Letters([word]).hashes()[0]) == h
            seen[i].add(word)
    for i, w in enumerate(words):  # deletions of words that stay long enough, replacements by larger letters
        gone = {w[:k] + w[k + 1:] for k in range(len(w))} if len(w) > 5 else set()
        up = {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in map(chr, SV.LETTERS) if c > w[k]}
        assert seen[i] == gone | up


def test_variants_of_nothing(spark):
    assert found_variants(documents(spark, [])) == {}
    assert found_variants(documents(spark, [(1, None), (2, "abcde abcde")])) == {}


# --- fill in the middle --------------------------------------------------------------

def middle(i, t):
    t = t or ""
    units = UNIT.findall(t)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[j:j + 8], 16) for j in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_equal_brute_force(spark):
    rows = given(spark) + [(i, t) for t in [*ODD_TEXTS, "a <M> b", "a <", "<<P", " \n ", "S>a\n"] for i in [None, *range(12)]]
    got = FM.fill_in_middle(documents(spark, rows))
    got = got.withColumn("back", FM.restored(got.form, got.output)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == middle(r.doc.doc_id, r.doc.text)
        assert r.back == (r.doc.text or "") and r.doc.n == 2 and r.doc.form == "f"
    assert {"plain", "spm", "psm"} == {r.form for r in got}


def test_middles_at_chunk_edges():
    rng = random.Random(5)
    memory = FM.ChunkMemory(1 << 15)
    pieces = ["word", "été", " ", "\n\t", "😀中", "x" * 5000, " " * 5000, "é" * 3000]
    base = "".join(rng.choice("ab é中\n😀 \t<PSM>") for _ in range(30_000))
    for k in range(600):
        a = rng.randrange(len(base))
        t = base[a: a + rng.choice([0, 1, 3, 50, 3000, 20_000])] if k % 3 else "".join(rng.choices(pieces, k=30))
        t = t if k % 5 else t.replace("<", "{")
        assert FM.rearrange(t, k, memory) == middle(k, t)
    assert memory.held <= 1 << 15


def test_shared_passages_are_counted_once():
    rng = random.Random(6)
    passage = " ".join(str(rng.random()) for _ in range(5000))
    memory = FM.ChunkMemory()
    first = FM.Units(f"one start {passage}".encode(), memory)
    counted = memory.counted
    assert counted > 50 and first.count == 5002
    again = FM.Units(f"another, longer start: {passage} and an end".encode(), memory)
    assert memory.counted - counted <= 6 and again.count == 5006


# --- decontamination -----------------------------------------------------------------

def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def leaks(rows, items, width=10):
    phrases = collections.defaultdict(set)
    for i, t in items:
        w = words_of(t)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            phrases[tuple(w[k: k + width])].add("" if i is None else str(i))
    lengths = {len(p) for p in phrases}
    for i, t in rows:
        w, hit, named = words_of(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k: k + n])) in phrases:
                    hit.update(range(k, k + n))
                    named |= phrases[p]
        yield i, t, len(w), hit, sorted(named)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, item long, phrase string")


def check_leaks(spark, rows, items, width=10):
    docs, tests = documents(spark, rows), benchmark(spark, items)
    got = collections.Counter()
    for r in DC.find_leaks(docs, tests, width=width).collect():
        hit = {w for s in r.spans for w in range(s.first_word, s.end_word)}
        assert all(a.end_word < b.first_word for a, b in zip(r.spans, r.spans[1:]))
        at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.doc.text or "").translate(LOWER))]
        assert all((s.start, s.end) == (at[s.first_word][0], at[s.end_word - 1][1]) for s in r.spans)
        got[r.doc.doc_id, r.doc.text, r.n_words, tuple(sorted(hit)), tuple(r["items"])] += 1
    want = list(leaks(rows, items, width))
    assert got == collections.Counter((i, t, n, tuple(sorted(hit)), tuple(named)) for i, t, n, hit, named in want)
    cleaned = collections.Counter(words_left for r in DC.remove_leaks(docs, tests, width=width).collect()
                                  for words_left in [(r.doc_id, tuple(words_of(r.text)), r.items, r.spans)])
    # removing words may join what stood around them only through the separators left in between
    assert cleaned == collections.Counter(
        (i, tuple(w for k, w in enumerate(words_of(t)) if k not in hit), 1, "s") for i, t, n, hit, _ in want)
    return want


def test_leaks_equal_brute_force(spark, monkeypatch):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    items += [(None, "Nine words, but no more, than these few ones."), (3, None), (4, ""), (5, "the the the the"), (5, "word " * 30)]
    passage = words_of(items[0][1])
    rows = given(spark) + [(i % 3, t) for i, t in enumerate(ODD_TEXTS)] + [(None, t) for t in ODD_TEXTS]
    rows += [(90, " ".join(["x", *passage[:10], "y", *passage[3:], *passage])), (90, "é " + "-".join(passage).upper() + "!")]
    want = check_leaks(spark, rows, items)
    assert sum(bool(hit) for *_, hit, _ in want) > 5
    monkeypatch.setattr(DC, "SHARD_WORDS", 7)  # a shard per row or two
    check_leaks(spark, rows[-30:], items[-8:])
    monkeypatch.setattr(DC, "BLOCK_BYTES", 300)  # many blocks, one pass each
    check_leaks(spark, rows[-6:], items[-6:])


def test_leaks_across_pieces_of_a_text(monkeypatch):
    monkeypatch.setattr(DC, "SHARD_WORDS", 7)
    rng = random.Random(12)
    for _ in range(30):
        rows = [(i, " ".join(rng.choices("ab", k=rng.choice([0, 3, 60])))) for i in range(4)]
        items = [(i, " ".join(rng.choices("ab", k=rng.choice([2, 4, 9])))) for i in range(4)]
        phrases = collections.defaultdict(list)
        for i, t in items:
            for k in range(max(1, len(t.split()) - 3)):
                phrases[" ".join(t.split()[k: k + 4]).encode()].append(str(i))
        got = DC._judge([t.encode() for _, t in rows], [([], [])] * 4, DC.Block(list(phrases.items()), 4))
        for (_, _, n, hit, named), (n_words, spans, items_found) in zip(leaks(rows, items, 4), got):
            assert (n, named) == (n_words, items_found)
            assert hit == {w for s in spans for w in range(s["first_word"], s["end_word"])}


def test_leaks_of_random_words(spark):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices(["a", "b", "B", "é"], k=n))
    check_leaks(spark, [(i, text(rng.choice([0, 3, 20, 200]))) for i in range(40)],
                [(i, text(rng.choice([0, 2, 5, 9]))) for i in range(12)], width=4)


def test_leaks_of_empty_tables(spark):
    assert DC.find_leaks(documents(spark, []), benchmark(spark, [(1, "a b")])).count() == 0
    assert DC.find_leaks(documents(spark, [(1, "a b")]), benchmark(spark, [])).first()["spans"] == []


def test_fm_index_equals_a_scan():
    rng = random.Random(1)
    for _ in range(60):
        symbols = rng.choice([1, 2, 3, 9, 70])
        pieces = [np.array(rng.choices(range(1, symbols + 1), k=rng.choice([0, 1, 2, 5, 40, 100])), dtype=np.int64)
                  for _ in range(rng.randint(1, 9))]
        pieces += [pieces[0]] * rng.choice([0, 3])
        index = FMIndex(pieces, symbols)
        width = rng.randint(1, 5)
        phrases = [rng.choices(range(1, symbols + 1), k=rng.randint(1, width)) for _ in range(20)]
        matrix = np.zeros((20, width), dtype=np.int64)
        for i, p in enumerate(phrases):
            matrix[i, width - len(p):] = p
        found, low, high = index.search(matrix)
        got = {(int(found[a]), int(b), int(c)) for which, piece, offset in index.locate(low, high)
               for a, b, c in zip(which, piece, offset)}
        assert got == {(i, j, k) for i, p in enumerate(phrases) for j, q in enumerate(pieces)
                       for k in range(len(q) - len(p) + 1) if list(q[k: k + len(p)]) == p}


def test_very_long_texts_in_bounded_time_and_memory():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    text = " ".join(rng.choices(words, k=300_000))  # 2 MB
    tracemalloc.start()
    start = time.time()
    block = DC.Block([(" ".join(text.split()[k: k + 10]).encode(), ["i"]) for k in range(0, 3000, 100)], 10)
    rows = DC._judge([text.encode()] * 3, [([], [])] * 3, block)
    assert rows[0][0] == 300_000 and sum(s["end_word"] - s["first_word"] for s in rows[2][1]) == 300
    FM.rearrange(text, 1, FM.ChunkMemory())
    SV.count_words(collections.Counter(), 1, text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert time.time() - start < 30 and most < 300 << 20


def test_registered(spark):
    found = queries()
    assert {"op11_spelling_variants", "op12_fill_in_middle", "op13_leak_index"} <= set(found)
    assert found["op12_fill_in_middle"](spark, SF).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
