"""Quotation linking: who quotes whom in a conversation, and conversations in reply order without quotes.

A line that starts with ``>`` marks is quoted; the number of marks is its level. Runs of lines
of one level are passages. A message's own lines, and its whole own text, are hashed after
normalising case and blanks; so are quoted passages and their lines. A quoted passage is
joined to the first message of the same conversation that said it, earlier than the quoting
one. The parent of a message is the origin of its level-1 passages (whole passages before
single lines, later origins before earlier). Parents are followed to the message that opened
the thread by pointer doubling, so deep chains take few rounds.

A message's ``position`` is its place in the reply order of its conversation: thread by thread, every reply after
what it answers (``thread_turn, turn``, then role and text). Positions come from a range partition of all messages
and the counts before each range, so a conversation of any size is never sorted in one task. ``conversations``
puts the messages without their quotes together in that order, in pieces of bounded length.

Defined results: a null or empty text is an empty body. Messages whose conversation or turn is
null link with nothing and have no position; each is a piece of its own. Repeated rows are separate messages of equal position. A message that
quotes nothing known opens its own thread. Lines that only announce a quotation (``On ... wrote:``)
go with the quotation. Other columns of the input are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.tables import parallelism, python_tasks, written

_QUOTED = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)(.*)")
_ANNOUNCED = re.compile(r"\s*On\b.+\bwrote:\s*", re.IGNORECASE)
#: Messages of a piece of a conversation at most.
PIECE = 256


def normalised(text: str) -> str:
    return " ".join(text.casefold().split())


def passage_hash(text: str) -> int | None:
    """64-bit hash of the normalised text; None if nothing is left."""
    text = normalised(text)
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True) if text else None


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """The text without quotations, and the quoted passages as (level, lines) in order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    open_level = 0
    for line in (text or "").split("\n"):
        m = _QUOTED.match(line)
        level = m[1].count(">") if m else 0
        if not level:
            own.append(line)
        else:
            if not open_level and own and _ANNOUNCED.fullmatch(own[-1]):
                own.pop()
            if level != open_level:
                passages.append((level, []))
            passages[-1][1].append(m[2])
        open_level = level
    return "\n".join(own).strip("\n"), passages


def _own_hashes(body: str) -> list[int]:
    found = [passage_hash(body), *map(passage_hash, body.split("\n"))]
    return [h for h in dict.fromkeys(found) if h is not None]


def _quote_hashes(passages: list[tuple[int, list[str]]]) -> list[dict]:
    out = []
    for no, (level, lines) in enumerate(passages):
        whole = passage_hash("\n".join(lines))
        if whole is not None:
            out.append({"no": no, "level": level, "rough": 0, "hash": whole})
            out += [{"no": no, "level": level, "rough": 1, "hash": h} for h in dict.fromkeys(map(passage_hash, lines))
                    if h is not None and h != whole]
    return out


_QUOTES = pa.list_(pa.struct([("no", pa.int32()), ("level", pa.int32()), ("rough", pa.int32()),
                              ("hash", pa.int64())]))


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, body, n_quotes, n_linked, parent_turn, thread_turn, position`` for every input row."""
    python_tasks(messages.sparkSession)
    named = messages.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [parse(t) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array([x[0] for x in parsed], pa.string()),
                pa.array([len(x[1]) for x in parsed], pa.int64()),
                pa.array([_own_hashes(x[0]) for x in parsed], pa.list_(pa.int64())),
                pa.array([_quote_hashes(x[1]) for x in parsed], _QUOTES),
            ], names=["conv_id", "turn", "role", "body", "n_quotes", "own", "quotes"])

    parsed = written(named.mapInArrow(
        run, "conv_id long, turn long, role string, body string, n_quotes long, own array<long>, "
             "quotes array<struct<no:int,level:int,rough:int,hash:long>>"), "quotes")
    placed = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = placed.where("n_quotes > 0").select("conv_id", "turn", F.explode("quotes").alias("q")).select(
        "conv_id", "turn", "q.*")
    origins = placed.select("conv_id", "turn", F.explode("own").alias("hash")).groupBy("conv_id", "hash").agg(
        F.min("turn").alias("origin"))
    found = quotes.join(origins, ["conv_id", "hash"]).where("origin < turn")
    # the best origin of the level-1 passages: exact before rough, then the latest
    best = F.min(F.when(F.col("level") == 1, F.struct("rough", (-F.col("origin")).alias("back"))))
    links = written(found.groupBy("conv_id", "turn").agg(
        (-best["back"]).alias("parent_turn"), F.count_distinct("no").alias("n_linked")), "quote-links")

    roots = links.where("parent_turn IS NOT NULL").select("conv_id", "turn", F.col("parent_turn").alias("root"))
    while True:
        up = roots.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("higher"))
        moved = written(roots.join(up, (F.col("conv_id") == F.col("c")) & (F.col("root") == F.col("t")), "left").select(
            "conv_id", "turn", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")),
            "quote-roots")
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    known = links.join(roots, ["conv_id", "turn"], "left")
    return _placed(parsed.join(known, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "n_quotes", F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        "parent_turn", F.coalesce("root", "turn").alias("thread_turn")))


def _placed(linked: DataFrame) -> DataFrame:
    """With ``position``: numbers within ranges of the order, and what of a conversation lies in the ranges before."""
    order = ("conv_id", "thread_turn", "turn", "role", "body_key")
    has_place = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    keyed = linked.withColumn("body_key", F.xxhash64("body"))
    # ids ascend within a range and from one range to the next
    dealt = written(keyed.where(has_place).repartitionByRange(parallelism(linked.sparkSession), *order).sortWithinPartitions(
        *order).withColumn("at", F.monotonically_increasing_id()).withColumn("stretch", F.shiftright("at", 33)), "reply-order")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("conv_id", "stretch").agg(F.min("at").alias("first"), F.count("*").alias("c")).withColumn(
        "offset", F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).drop("first", "c")
    columns = [*linked.columns, "position"]
    inside = dealt.join(starts, ["conv_id", "stretch"]).withColumn("position", F.col("at") + F.col("offset")).select(*columns)
    return inside.unionByName(linked.where(~has_place).withColumn("position", F.lit(None).cast("long")).select(*columns))


def conversations(linked: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, thread_turn, piece, messages`` from the rows of ``link_quotations``: each thread's messages without
    quotes in reply order, ``piece`` of them a row at most; pieces of a conversation ascend in that order."""
    message = F.struct("position", "turn", "role", "body", "parent_turn")
    has_place = F.col("position").isNotNull()
    placed = linked.where(has_place).groupBy(
        "conv_id", "thread_turn", F.floor(F.col("position") / F.lit(piece)).alias("piece")).agg(
        F.sort_array(F.collect_list(message)).alias("messages"))
    return placed.unionByName(linked.where(~has_place).select(
        "conv_id", "thread_turn", F.lit(0).cast("long").alias("piece"), F.array(message).alias("messages")))
