"""The splittable label reader against the whole-file reader, on every layout, at every split."""

import json
import os
import random
import tempfile

import pytest

from cardlake.sources import files as FS
from cardlake.sources import json_split as JS
from cardlake.sources import split_scan as SS

SCOPED = {"1": "Yes", "2": None, "3": "No, disputed", "4": 'a "b" {c}, "9": "x"', "5": "back\\", "6": "\\\"", "7": "[,]", "é\n": "z"}


def folder(*texts):
    base = tempfile.mkdtemp(dir="/tmp")
    for i, text in enumerate(texts):
        with open(os.path.join(base, f"f{i}.json"), "w") as f:
            f.write(text)
    return base


def rows(df):
    return sorted(((r.transaction_id, r.fraud_label) for r in df.collect()), key=repr)


LAYOUTS = {
    "one_line": json.dumps({"target": SCOPED}),
    "pretty": json.dumps({"target": SCOPED}, indent=2),
    "brace_on_next_line": '{"target":\n{\n"1": "Yes",\n"2": "No"}}',
    "open_and_entry_on_a_line": '{"target": {"1": "Yes",\n"2": "No"\n}}',
    "close_on_entry_line": '{\n"target": {\n"1": "Yes",\n"2": "No"}\n}',
    "two_on_a_line": '{"target": {\n"1": "Yes", "2": "No",\n"3": "No"\n}\n}',
    "numbers_and_nested": '{"target": {"1": 5, "2": 1.50, "3": true, "4": {"a": [1, "},{"], "b": {}}, "5": [], "6": null}}',
    "nested_target": '{"meta": {"target": {"9": "Yes"}, "x": [{"target": {"8": "a"}}]}, "target": {"1": "No"}, "z": {"7": "b"}}',
    "escaped_key": '{"t\\u0061rget" : {"1":"Yes"} , "tar,get": {"2": "No"}, "a\\"target": {"3": "x"}}',
    "empty": '{"target": {}}',
    "no_object": '{"target": [1, {"2": "x"}], "other": {"1": "y"}}',
    "array_on_top": '[{"target": {"1": "Yes"}}]',
    "string_only": '"target"',
    "commas_only_in_strings": '{"target": {"1": "' + "a," * 300 + '", "2": "' + "\\\\," * 99 + '"}}',
    "tabs_and_returns": '{\r\n\t"target"\t:\r\n{\t"1"\r\n:\t"Yes"\r\n,\r\n"2":"No"\r\n}\r\n}\r\n',
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts_equal_whole_file(spark, name):
    path = folder(LAYOUTS[name])
    want = rows(FS.bronze_fraud_labels_whole(spark, path))
    assert rows(FS.bronze_fraud_labels_split(spark, path)) == want
    assert name in ("empty", "no_object", "array_on_top", "string_only") or want


def test_several_objects_and_files(spark):
    two = '{"target": {"1": "Yes"}}\n{"target": {"2": "No", "3": null}} {"target":{"4":"x"}}'
    got = rows(FS.bronze_fraud_labels_split(spark, folder(two, "", " ", LAYOUTS["pretty"])))
    assert got == sorted([(1, "Yes"), (2, "No"), (3, None), (4, "x"), *rows(
        FS.bronze_fraud_labels_whole(spark, folder(LAYOUTS["pretty"])))], key=repr)


def test_one_giant_line_is_read_by_many_tasks(spark):
    rng = random.Random(1)
    labels = {str(i): rng.choice(["Yes", "No", None, "a, b", "\\,\"", "{,"]) for i in range(60_000)}
    path = folder(json.dumps({"x": [1, 2], "target": labels, "after": {"5": "n"}}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        df = FS.bronze_fraud_labels_split(spark, path)
        got = rows(df)
        splits = spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits > 6
    assert got == sorted(((int(k), v) for k, v in labels.items()), key=repr)


def cut_and_joined(text, cuts, key="target"):
    """The scan without Spark: chunks end behind commas, each starts from the state before it."""
    automaton = JS.ObjectEntries(key)
    edges = [0, *cuts, len(text)]
    inside, stack, whole, parts = False, "", [], []
    splits = [text[a:b] for a, b in zip(edges, edges[1:])]
    splits[-1] += b","
    total = SS.NOTHING
    for chunk in splits:
        assert SS.applied(total, False, "") == (inside, stack)
        found = list(automaton.runs(chunk, inside, stack))
        assert automaton.overhangs(inside, stack) == bool(found and found[0][0] > 1)
        for part, run in found:
            if part == 0:
                whole.append(run)
            elif part == 1:
                parts.append(run)
            else:
                parts[-1] += run
        effect = automaton.effect(chunk)
        total = SS.composed(total, effect)
        inside, stack = SS.applied(effect, inside, stack)
        assert automaton.overhangs(inside, stack) == any(part in (1, 2) for part, _ in found)
    found = {}
    for run in whole + parts:
        found.update(json.loads(b"{" + run + b"}"))
    return found


def random_json(rng, depth):
    strings = ["", "a", ",", "a,b", '"', "\\", '\\",', "{", "}]", "é,\n", "target", ": {"]
    if depth > 3 or rng.random() < 0.5:
        return rng.choice([None, True, 1, -2.5e3, *strings])
    if rng.random() < 0.4:
        return [random_json(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(strings) + str(rng.randint(0, 5)): random_json(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def test_every_cut_gives_the_same_entries():
    rng = random.Random(7)
    for trial in range(300):
        wanted = {rng.choice(["k", ",", '"', "\\", "é"]) + str(i): random_json(rng, 2) for i in range(rng.randint(0, 5))}
        obj = {"a": random_json(rng, 1), "target": wanted, "b": random_json(rng, 1)}
        text = json.dumps(obj, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5).encode()
        commas = [i + 1 for i, c in enumerate(text) if c == ord(",")]
        for cuts in (commas, sorted(rng.sample(commas, rng.randint(0, len(commas)))), []):
            assert cut_and_joined(text, cuts) == wanted, (trial, text, cuts)
