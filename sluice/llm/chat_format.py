"""Reply trees to conversations: root-to-leaf paths by self-joins, ranked by score, each formatted as one training text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm._frames import id_back, id_of, written
from sluice.llm._order import numbered
from sluice.plans.skew import lookup_join

# fixed values: the control strings of the template, and the role that is learnt
BEGIN, END, ASSISTANT = "<|im_start|>", "<|im_end|>", "assistant"
#: Code points after which a conversation goes on in a further row.
PART_CHARS = 1 << 24

FORMATTED = "path bigint, conv_id bigint, part int, formatted string, loss array<struct<start:int,end:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FORMATTED = pa.schema(
    [("path", pa.int64()), ("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.large_string()), ("loss", pa.list_(_SPAN))]
)
READ = (
    "path bigint, conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)
_READ = pa.schema(
    [("path", pa.int64()), ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
    + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def escape(text: str) -> str:
    """``text`` with one backslash more in every ``<``, backslashes, ``|``; it holds no control string then."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text), flags=re.S)


def _climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``(ends, hops)``: for each message its root, depth and the scores on the way there; and its ancestor 1, 2, 4 ... up.

    Each step joins the pointers with themselves, which doubles their reach. When a step brings no further message to a
    root, those left are on cycles.
    """
    known = messages.select(F.col("id").alias("parent")).distinct()
    linked = messages.where("parent is not null")
    hops = [written(lookup_join(linked.select("id", "parent"), known, "parent", "left_semi").select("id", F.col("parent").alias("above")))]
    state = written(
        messages.select("id", "score").join(hops[0].hint("merge"), "id", "left")
        .select("id", F.col("above").alias("next"), F.when(F.col("above").isNull(), F.col("id")).alias("root"), F.lit(1).alias("depth"), "score")
    )
    left = -1
    while True:
        now = state.where("root is null").count()
        if now in (0, left):
            return state.where("root is not null").select("id", "root", "depth", "score"), hops
        left = now
        ends = state.select(
            F.col("id").alias("next"), F.col("next").alias("_next"), F.col("root").alias("_root"),
            F.col("depth").alias("_depth"), F.col("score").alias("_score"),
        )
        done = state.where("root is not null")
        further = lookup_join(state.where("root is null"), ends, "next").select(
            "id", F.col("_next").alias("next"), F.col("_root").alias("root"),
            (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("score") + F.col("_score")).alias("score"),
        )
        state = written(done.unionByName(further))
        reach = hops[-1]
        hops.append(
            written(
                lookup_join(
                    reach.select("id", F.col("above").alias("via")),
                    reach.select(F.col("id").alias("via"), F.col("above").alias("above")),
                    "via",
                ).select("id", "above")
            )
        )


def reply_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``(path, rank, depth, id)``: the messages of each tree's ``keep`` best root-to-leaf paths, the root at depth 1.

    ``messages`` has ``id`` (bigint, unique), ``parent`` (null for a root) and ``score``. A path's score is
    the sum over its messages, null counting as 0; the smaller leaf goes first among equals, and ``path`` is the leaf's
    id. A message whose parent is not there is a root; messages on a cycle reach no root and are on no path.
    An empty table gives no rows.
    """
    ends, hops = _climbed(messages.select("id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")))
    leaves = ends.join(hops[0].select(F.col("above").alias("id")).distinct().hint("merge"), "id", "left_anti")
    # Spark cuts each task's rows to the first of a tree before it moves them
    best = Window.partitionBy("root").orderBy(F.desc("score"), "id")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    rows = written(chosen.select(F.col("id").alias("path"), "rank", "depth", "id"))
    # from the longest hop down, every message found so far gives the one that far above it as well
    for k in reversed(range(len(hops))):
        above = rows.join(hops[k].hint("merge"), "id").select(
            "path", "rank", (F.col("depth") - (1 << k)).alias("depth"), F.col("above").alias("id")
        )
        rows = written(rows.unionByName(above))
    return rows


def _format_rows(part_chars: int):
    """Rows ``(path, conv_id, role, text)`` in order to formatted parts with the spans of answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, part, pieces, loss, size = None, 0, [], [], 0

        def row() -> pa.RecordBatch:
            values = [[open_[0]], [open_[1]], [part], ["".join(pieces)], [[{"start": a, "end": b} for a, b in loss]]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _FORMATTED)], schema=_FORMATTED)

        for batch in batches:
            for path, conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_ is not None and (open_[0] != path or size >= part_chars):
                    yield row()
                    part, pieces, loss, size = (part + 1 if open_[0] == path else 0), [], [], 0
                open_ = (path, conv)
                head, body = f"{BEGIN}{_escape_role(role)}\n", escape(text)
                if role == ASSISTANT:
                    loss.append((size + len(head), size + len(head) + len(body)))
                pieces += [head, body, END, "\n"]
                size += len(head) + len(body) + len(END) + 1
        if open_ is not None:
            yield row()

    return run


def format_paths(paths: DataFrame, messages: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """``(path, conv_id, part, formatted, loss)``: each path as one conversation, with the spans of escaped answers.

    ``messages`` has ``id``, ``conv_id``, ``role``, ``text``; null roles and texts count as empty. A turn is ``<|im_start|>role``, a line
    feed, the text, ``<|im_end|>`` and a line feed; control strings inside texts and roles are escaped so that they can be told
    apart, and :func:`read_back` undoes it. A conversation longer than ``part_chars`` goes on in a further
    row, between turns: a task holds one such row, not a conversation.
    """
    said = messages.select(
        "id", "conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = lookup_join(paths.select("path", "depth", "id"), said, "id")
    return (
        rows.repartition("path")
        .sortWithinPartitions("path", "depth")
        .select("path", "conv_id", "role", "text")
        .mapInArrow(_format_rows(part_chars), FORMATTED)
    )


_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = None

    def row() -> pa.RecordBatch:
        path, conv, turns, all_turns, loss_chars, loss, chars = open_
        values = [[path], [conv], [turns], [all_turns.hexdigest()], [loss_chars], [loss.hexdigest()], [chars]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _READ)], schema=_READ)

    for batch in batches:
        for path, conv, formatted, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if open_ is None or open_[0] != path:
                if open_ is not None:
                    yield row()
                open_ = [path, conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            at = 0
            for turn in _TURN.finditer(formatted):
                if turn.start() != at:
                    raise ValueError(f"path {path}: text outside of turns")
                at = turn.end()
                open_[2] += 1
                open_[3].update(f"{_unescape_role(turn[1])}\n{unescape(turn[2])}\n".encode())
            if at != len(formatted):
                raise ValueError(f"path {path}: text after the last turn")
            for span in spans:
                learnt = unescape(formatted[span["start"] : span["end"]])
                open_[4] += len(learnt)
                open_[5].update(learnt.encode())
            open_[6] += len(formatted)
    if open_ is not None:
        yield row()


def read_back(formatted: DataFrame) -> DataFrame:
    """``(path, conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of each conversation.

    Turns are told apart by their marks and unescaped; the loss columns are of what lies in the stored spans.
    Parts are read in order and one at a time, however many a conversation has.
    """
    return (
        formatted.repartition("path")
        .sortWithinPartitions("path", "part")
        .select("path", "conv_id", "formatted", "loss")
        .mapInArrow(_read_rows, READ)
    )


def reply_chain(turns: DataFrame) -> DataFrame:
    """``(id, parent, score, conv_id, role, text)``: rows by turn as messages, each a reply to the one before it.

    ``turns`` is a table read from files, with ``conv_id``, ``turn``, ``role``, ``text``; other columns are not read. A null id is one
    conversation, a null turn comes before all others. Rows of one turn follow each other by role and text, nulls
    first, and rows that are equal all stay. All messages score alike. No task holds a conversation whole.
    """
    rows = turns.select(id_of("conv_id").alias("_conv"), "turn", "role", "text")
    # a long text would be a long sort key
    placed = numbered(rows.withColumn("_head", F.substring("text", 1, 64)).withColumn("_hash", F.xxhash64("text")), "_conv", "turn", "role", "_head", "_hash", name="id")
    firsts = placed.groupBy("_conv").agg(F.min("id").alias("first"))
    return written(
        lookup_join(placed, firsts, "_conv").select(
            "id", F.when(F.col("id") > F.col("first"), F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"),
            id_back("_conv").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
        )
    )


def chat_format(messages: DataFrame, keep: int = 1, part_chars: int = PART_CHARS) -> DataFrame:
    """The ``keep`` best paths of each reply tree of ``messages`` as formatted conversations, written.

    See :func:`reply_paths` and :func:`format_paths` for the columns read and for nulls, ties and broken links; other
    columns may have any names. Texts may be empty or of any length that fits a row. An empty table gives no rows.
    """
    return written(format_paths(reply_paths(messages, keep), messages, part_chars))
