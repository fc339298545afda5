"""Operators that judge one text at a time, against plain Python."""

import collections
import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from cardlake.llm import license_scan as LS
from cardlake.llm import repetition as RP
from cardlake.llm.bpe_trie import TrieBPE, bpe_decode, bpe_digests, bpe_encode
from cardlake.llm.queries import queries, tokenizer_path
from cardlake.llm.tables import table

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, extra=()):
    """Rows (id, text) with columns whose names operators might use themselves."""
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, t, "x", "y", 1) for t in extra]
    return spark.createDataFrame(rows, "doc_id long, text string, labels string, kept string, n long")


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in LS.BASE_PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i: i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


LICENCES = [
    "Under the MIT License.", "x under, the (MIT) license under the mit license", "apache license version 2 cc-by nc 4",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause, and more prose follows here",
    "SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0", "SPDX-License-Identifier: OR )(",
    "spdx license identifier", "Cc By Nc " * 3, "undér the mit license",
]


def test_license_scan_equals_brute_force(spark):
    texts = LICENCES + ODD_TEXTS + [r.text for r in table(spark, SF, "documents").collect()]
    for r in LS.license_scan(documents(spark, texts, ["under the mit license"])).collect():
        t = texts[r.doc_id] if r.doc_id is not None else "under the mit license"
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_base(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_expressions():
    got = LS.scan(LICENCES[3])
    assert got["expressions"] == ["( MIT OR Apache-2.0 ) AND BSD-3-Clause"]
    assert got["labels"] == "apache-2,bsd,mit" and got["usage"] == "permissive" and got["score"] == 1.0
    assert LS.scan(LICENCES[4])["labels"] == "gpl-2"
    assert LS.scan(LICENCES[5])["expressions"] == []
    post = LS.to_postfix("a or b and c with e".split())
    assert post == ["a", "b", "c", "e", "with", "and", "or"]
    assert LS.to_postfix(["a", "b"]) is None and LS.to_postfix(["(", "a"]) is None


def test_license_expressions_of_any_length():
    start = time.time()
    got = LS.scan("SPDX-License-Identifier: " + "(a-1 and " * 100_000 + "mit")
    assert got["expressions"] == [] and got["n_words"] == 300_000 + 4
    many = LS.scan("SPDX-License-Identifier: " + " or ".join(f"a-{i}" for i in range(60_000)) + " and more prose follows")
    assert len(many["labels"].split(",")) == 60_000
    nested = LS.scan("SPDX-License-Identifier: " + "(" * 50_000 + "MIT" + " or isc)" * 50_000)
    assert nested["labels"] == "isc,mit"
    assert time.time() - start < 20


def test_punctuation_behind_an_identifier():
    for text, labels in (("MIT.", "mit"), ("MIT-->", "mit"), ("MIT OR Apache-2.0.", "apache-2,mit"), ("GPL-2.0+.", "gpl-2"),
                         ("(MIT OR ISC).", "isc,mit"), ("MIT. and BSD-3-Clause is not meant", "mit"), ("Custom-1.-", "custom-1")):
        assert LS.scan("SPDX-License-Identifier: " + text)["labels"] == labels


def test_license_expression_ends_before_prose():
    got = LS.scan("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause and more prose follows here")
    assert got["expressions"] == ["( MIT OR Apache-2.0 ) AND BSD-3-Clause"]
    assert got["labels"] == "apache-2,bsd,mit" and got["usage"] == "permissive"
    for tail in ("or later.", "with no warranty"):
        assert LS.scan(f"SPDX-License-Identifier: MIT {tail}")["labels"] == "mit"
    assert LS.scan("SPDX-License-Identifier: mit or (isc and apache-2.0)")["labels"] == "apache-2,isc,mit"
    assert LS.scan("SPDX-License-Identifier: MIT OR Zlib")["labels"] == "mit,zlib"


def repetition_base(text):
    w = WORD.findall(text or "")
    tri = collections.Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    repeat = {i + j for i in range(len(w) - 2) if tri[tuple(w[i: i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat)


def test_repetition_rules_equal_brute_force(spark):
    texts = ODD_TEXTS + [r.text for r in table(spark, SF, "documents").collect()]
    for r in RP.repetition_rules(documents(spark, texts, [None])).collect():
        want = repetition_base(texts[r.doc_id] if r.doc_id is not None else None)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def ngram_share(text, n):
    w = WORD.findall(text)
    count = collections.Counter(tuple(w[i: i + n]) for i in range(len(w) - n + 1))
    inside = {i + j for i in range(len(w) - n + 1) if count[tuple(w[i: i + n])] > 1 for j in range(n)}
    return sum(len(w[i]) for i in inside) / max(1, sum(map(len, w)))


def test_ngram_coverage_equals_brute_force(spark):
    for t in [x for x in ODD_TEXTS if x][:5] + [r.text for r in table(spark, SF, "documents").limit(40).collect()]:
        got = RP.coverage(t)["dup_ngram_shares"]
        assert got == pytest.approx([ngram_share(t, n) for n in sorted(RP.MAX_NGRAM_SHARE)])


BPE_TEXTS = ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "don't I'LL we're it'S 's", "ΑΣ ΟΔΟΣ", "é ́a", "x" * 500,
             "!" * 300, "a\u1c89b \ua7ceb x\U00016ea0y <|endoftext|>\U000125a3z", "\x00\x7f\x1c a", "  \xa0　x"]


def test_bpe_equals_the_library_and_round_trips(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    texts = BPE_TEXTS + ODD_TEXTS + [r.text for r in table(spark, SF, "documents").collect()]
    docs = documents(spark, texts)
    encoded = bpe_encode(docs, tokenizer_path())
    ids = {r.doc_id: list(r.ids) for r in encoded.collect()}
    decoded = {r.doc_id: r.text for r in bpe_decode(encoded, tokenizer_path()).collect()}
    digests = {r.doc_id: r for r in bpe_digests(docs, tokenizer_path()).collect()}
    for i, t in enumerate(texts):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert ids[i] == want, t
        back = lib.decode(want, skip_special_tokens=False)
        assert decoded[i] == back
        d = digests[i]
        assert (d.n_tokens, d.ids_sha256, d.decoded_sha256) == (
            len(want), hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_bpe_long_runs_without_blanks():
    from tokenizers import Tokenizer

    spec = open(tokenizer_path(), encoding="utf-8").read()
    lib, bpe, r = Tokenizer.from_str(spec), TrieBPE(spec), random.Random(4)
    runs = ["".join(r.choices("acgt", k=300_000)), "".join(r.choices("中文字不空格ไทย", k=100_000)),
            "internationalisation" * 15_000, "x" * 1_000 + "y", "ab" * 500, "".join(r.choices("eta oinshr", k=5_000))]
    tracemalloc.start()
    got = bpe.encode_batch(runs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for text, ids in zip(runs, got):
        assert np.frombuffer(ids, dtype="<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text[:30]
    assert most < 200e6


@pytest.mark.parametrize("op", [LS.license_scan, RP.repetition_rules, lambda d: bpe_digests(d, tokenizer_path())])
def test_empty_table(spark, op):
    assert op(documents(spark, [])).collect() == []


def test_registered():
    assert [q.split("_")[0] for q in queries()] == [f"op{i}" for i in range(1, 14)]
