"""Quality classifier, quotation linking and the corpus pipeline."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from cardlake.llm import weak_labels as WL
from cardlake.llm.quote_threads import conversations, link_quotations, parse
from cardlake.llm.tables import table, written

from .conftest import ODD_TEXTS
from .test_pair_operators import brute_join
from .test_search_secrets_mix import brute_mix, spans_of

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    """The labels are not read by the classifier: all of them are held out."""
    got = {r.doc_id: r for r in WL.quality_scores(table(spark, SF, "documents")).collect()}
    labels = table(spark, SF, "labels").collect()
    right = sum((got[x.doc_id].kept) == (x.quality == 1) for x in labels)
    clean = [x for x in labels if x.quality == 1]
    assert right >= 0.95 * len(labels)
    assert sum(got[x.doc_id].kept for x in clean) >= 0.99 * len(clean)


def test_em_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.8
    counts = {}
    said = []
    for y in truth:
        vote = []
        for accuracy in (0.95, 0.9, 0.85, 0.9, 0.8, 0.9):
            vote.append(2 if rng.random() < 0.2 else int(y if rng.random() < accuracy else not y))
        key = int("".join(map(str, vote)), 3)
        said.append(key)
        counts[key] = counts.get(key, 0) + 1
    post = WL.fit(counts, 6)
    assert np.mean([(post[k] >= 0.5) == y for k, y in zip(said, truth)]) > 0.95
    assert WL.fit({}) == {}


def test_trigrams_equal_brute_force():
    raws = [b"abc", b"", b"ab", b"x1yzw", "é😀x".encode(), b"hello world"]
    bucket, n = WL._trigrams(raws)
    want = [[r[i: i + 3] for i in range(len(r) - 2) if not any(WL._SAYS_NOTHING[c] for c in r[i: i + 3])] for r in raws]
    assert n.tolist() == [len(w) for w in want]
    assert len(bucket) == n.sum()
    one = [WL._trigrams([g])[0][0] for w in want for g in w]
    assert bucket.tolist() == one


def odd_documents(spark):
    rows = [(i, t, "en", "src1", 5) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "plain words without an id here", None, None, None), (3, "one", "en", "src1", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "'x' AS votes", "'y' AS score", "'z' AS digest", "1 AS mix_key", "'k' AS doc", "2 AS epoch")


def test_quality_odd_rows(spark):
    docs = odd_documents(spark)
    scores = WL.quality_scores(docs).collect()
    assert len(scores) == docs.count()
    assert all(r.score == 0 and not r.kept for r in scores if r.n_words == 0)
    kept = WL.quality_filter(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in scores)
    assert WL.quality_scores(docs.where(F.lit(False))).collect() == []
    assert WL.quality_filter(docs.where(F.lit(False))).collect() == []


def test_stages_take_odd_rows_and_keep_columns(spark):
    docs = odd_documents(spark)
    for name, stage in CP.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.where(F.lit(False)), SF).collect() == []
    assert CP.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_pipeline_stages_equal_plain_python(spark):
    docs = table(spark, SF, "documents")
    scores = {r.doc_id for r in WL.quality_scores(docs).collect() if r.kept}
    for name, stage in CP.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        if name == "quality":
            assert {r.doc_id for r in after} == scores
        elif name == "near_duplicates":
            groups = brute_join([(r.doc_id, r.text) for r in before])
            assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c, _) in groups.items() if i == c)
        elif name == "secrets":
            texts = {r.doc_id: r.text for r in before}
            assert len(after) == len(before)
            for r in after:
                assert (r.text == texts[r.doc_id]) == (not spans_of(texts[r.doc_id]))
                assert r.n_chars == (len(r.text) if spans_of(texts[r.doc_id]) else r.n_chars)
        elif name == "mixing":
            rows = [(r.doc_id, r.text, r.lang, r.source, f"d{int(r.source[3:]) % 4}") for r in before]
            want = brute_mix(rows, CP.PIPELINE_SHARE, 1, CP.MIX_WEIGHTS, CP.MIX_SEED)
            assert sorted(r.doc_id for r in after) == sorted(i for i, _, _ in want)
        else:
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    ran = CP.run(spark, SF).collect()
    assert json.dumps(sorted([r.doc_id, r.n_tokens] for r in ran)) == json.dumps(
        sorted([r.doc_id, r.n_tokens] for r in docs.collect()))


def test_quotation_parsing():
    body, quoted = parse("Hi\nOn Monday, A wrote:\n> first line\n> more\n>> older\n> back\nmy answer")
    assert body == "Hi\nmy answer"
    assert quoted == [(1, ["first line", "more"]), (2, ["older"]), (1, ["back"])]
    assert parse(None) == ("", []) and parse("") == ("", [])


def test_quotations_link_to_their_origin(spark):
    rows = [
        (1, 0, "user", "Where is the key?\nIt was here."), (1, 1, "assistant", "> where is  the KEY?\nOn the table."),
        (1, 2, "user", "Something else entirely."), (1, 3, "assistant", "> On the table.\n>> Where is the key?\nNo, moved."),
        (1, 4, "user", "> never said\nhm"), (1, 5, "user", "> Where is the key?\n> It was here.\nagain"),
        (2, 0, "user", "> Where is the key?\nother conversation"), (None, 0, "user", "> x"), (1, None, "user", "> x"),
        (3, 0, "user", None), (3, 1, "user", ""), (3, 1, "user", ""),
    ] + [(9, i, "user", f"> m{i - 1}\nm{i}") for i in range(1, 40)] + [(9, 0, "user", "m0")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS hash", "2 AS root", "3 AS body")
    got = link_quotations(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got if r.conv_id in (1, 2)}
    assert by[1, 1].parent_turn == 0 and by[1, 1].body == "On the table." and by[1, 1].thread_turn == 0
    assert by[1, 3].parent_turn == 1 and by[1, 3].n_linked == 2 and by[1, 3].thread_turn == 0
    assert by[1, 4].parent_turn is None and by[1, 4].n_linked == 0 and by[1, 4].thread_turn == 4
    assert by[1, 5].parent_turn == 0 and by[2, 0].parent_turn is None and by[1, 2].thread_turn == 2
    chain = [r for r in got if r.conv_id == 9]
    assert all(r.thread_turn == 0 for r in chain)
    assert link_quotations(df.where(F.lit(False))).collect() == []


def threads(rows):
    """Plain Python over (conv, turn, role, text): body, quotes, linked quotes, parent, thread, in reply order."""
    said = {}
    parsed = [(c, t, r, *parse(x)) for c, t, r, x in rows]
    flat = lambda x: " ".join(x.casefold().split())
    for c, t, _, body, _ in parsed:
        if c is not None and t is not None:
            for own in {flat(body), *map(flat, body.split("\n"))} - {""}:
                said.setdefault((c, own), []).append(t)
    parent, linked = {}, {}
    for c, t, _, _, passages in parsed:
        best, numbers = None, set()
        for no, (level, lines) in enumerate(passages):
            whole = flat("\n".join(lines))
            for rough, text in [(0, whole), *((1, flat(x)) for x in lines if flat(x) != whole)]:
                origin = min(said.get((c, text), [t]) if text and c is not None and t is not None else [0])
                if text and c is not None and t is not None and origin < t:
                    numbers.add(no)
                    if level == 1:
                        best = min(best or (rough, -origin), (rough, -origin))
        if c is not None and t is not None:
            linked.setdefault((c, t), set()).update(numbers)
            if best and (parent.get((c, t)) is None or best < parent[c, t]):
                parent[c, t] = best
    parent = {k: -v[1] for k, v in parent.items()}

    def root(c, t):
        while (c, t) in parent:
            t = parent[c, t]
        return t

    return [(c, t, r, body, len(q), len(linked.get((c, t), ())), parent.get((c, t)), root(c, t)) for c, t, r, body, q in parsed]


def quoting_chat(rng, conv, turns):
    said, out = [], []
    for t in range(turns):
        text = f"Message {t} of {conv}\n{rng.choice(['same words', 'Other  Words', 'line ' + str(t)])}"
        if said and rng.random() < 0.8:
            quoted = rng.choice(said).split("\n")
            quoted = quoted if rng.random() < 0.6 else quoted[: rng.randint(1, len(quoted))]
            lines = [">" + (" " if rng.random() < 0.5 and not x.startswith(">") else "") + x.upper() for x in quoted]
            announce = f"On {'x' * rng.choice([3, 900])} you wrote:\n" if rng.random() < 0.5 else ""
            text = announce + "\n".join(lines) + "\n" + text if rng.random() < 0.7 else text + "\n" + "\n".join(lines)
        said.append(text)
        out.append((conv, t, rng.choice(["user", "assistant"]), text))
    return out


def test_threads_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [r for c in range(25) for r in quoting_chat(rng, c, rng.randint(1, 14))]
    rows += [(None, 1, "user", "> same words"), (3, None, "user", "> same words"), (99, 1, "user", None), (99, 2, "user", "")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS body", "1 AS position", "2 AS thread_turn", "'y' AS own")
    linked = link_quotations(df)
    want = threads(rows)
    got = linked.collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in got))) == sorted(map(repr, want))
    assert sum(r.parent_turn is not None for r in got) > 40 and any(r.n_linked > 1 for r in got)
    by_conv = {}
    for r in got:
        if r.position is not None:
            by_conv.setdefault(r.conv_id, []).append((r.position, r.thread_turn, r.turn))
    for places in by_conv.values():
        places.sort()
        assert [p for p, *_ in places] == list(range(len(places)))
        assert [x[1:] for x in places] == sorted(x[1:] for x in places)
    pieces = conversations(linked, piece=3).collect()
    assert all(len(p.messages) <= 3 for p in pieces) and sum(len(p.messages) for p in pieces) == len(rows)
    assert not any(line.startswith(">") for p in pieces for m in p.messages for line in m.body.split("\n"))
    for c, places in by_conv.items():
        mine = sorted((p for p in pieces if p.conv_id == c and p.messages[0].position is not None),
                      key=lambda p: (p.thread_turn, p.piece))
        assert [m.position for p in mine for m in p.messages] == list(range(len(places)))
