"""Transcripts to canonical chat turns: a hidden Markov model over lines recovers who speaks.

A state is a role and whether the line opens a turn. A line is seen as its speaker marker (``User:``,
``AI>``, ``[system]`` ...) and a few features (blank, question, length). The model is counted from
labelled transcripts by grouped aggregation; Viterbi finds the best states of a transcript.

A transcript may be of any length. It is cut into blocks of consecutive positions; a block is
summed up by the best score between each state before it and at its end, the summaries of
BLOCK blocks make one of the next level, and so on until one is left. Going down again, the states at
the ends of each block are fixed level by level, and at last those of the lines in it. Every group
has a bounded number of members, and the path is a best path of the whole transcript.
"""

import re
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ridemetrics.llm.common import partitions, set_up, shared_folder, store
from ridemetrics.operators.frames import dense_index, order_rows

ROLES = ["system", "user", "assistant"]
# Positions in a block, and blocks in one of the next level.
BLOCK = 64

MARKERS = {
    "system": {"system", "instruction", "instructions", "context", "sys"},
    "user": {"user", "human", "q", "question", "customer", "me", "prompter", "you"},
    "assistant": {"assistant", "ai", "a", "answer", "bot", "model", "agent", "chatbot"},
}
_MARKER_CLASS = {word: 1 + ROLES.index(role) for role, words in MARKERS.items() for word in words}
_MARKER = re.compile(r"^[\s#*\[<|>-]*([A-Za-z]{1,16})(?:[*\]|>]+(?=[\s:]|$):?|\s*:)[\s*]*")
N_SYMBOLS = 5 * 5
N_STATES = 2 * len(ROLES)
START = N_STATES  # before the first line


def marker(line: str) -> tuple[int, int]:
    """Class of a line's speaker marker (0: none, 1-3: a role, 4: another name) and where the text begins."""
    found = _MARKER.match(line)
    if not found:
        return 0, 0
    known = _MARKER_CLASS.get(found[1].lower(), 4)
    return known, found.end() if known < 4 else 0


def symbol(line: str) -> int:
    """What the model sees of a line."""
    kind, start = marker(line)
    text = line[start:].strip()
    shape = 0 if not text else 1 if text.endswith("?") else 2 if len(text) < 80 else 3 if len(text) < 300 else 4
    return kind * 5 + shape


class LineModel:
    """Log probabilities with add-one smoothing over the moves that make sense."""

    def __init__(self, moves: dict, shows: dict):
        """``moves``: counts of (state, next state); ``shows``: counts of (state, symbol)."""
        allowed = np.zeros((N_STATES + 1, N_STATES), bool)
        allowed[:, 0::2] = True  # any line may open a turn
        allowed[range(0, N_STATES, 2), range(1, N_STATES, 2)] = True
        allowed[range(1, N_STATES, 2), range(1, N_STATES, 2)] = True
        a = allowed.astype(float)
        for (s, t), n in moves.items():
            if allowed[s, t]:
                a[s, t] += n
        b = np.ones((N_STATES, N_SYMBOLS))
        for (s, o), n in shows.items():
            b[s, o] += n
        with np.errstate(divide="ignore"):
            self.move = np.log(a / a.sum(1, keepdims=True))
        self.show = np.log(b / b.sum(1, keepdims=True))

    def summary(self, symbols) -> np.ndarray:
        """Best score from each state before the lines to each state at their end."""
        best = self.move + self.show[:, symbols[0]]
        for o in symbols[1:]:
            best = (best[:, :, None] + self.move[None, :N_STATES]).max(1) + self.show[:, o]
        return best

    def path(self, symbols, first: int, last: int) -> list[int]:
        """Best states of the lines from state ``first`` before them to state ``last`` at the end."""
        best, back = self.move[first] + self.show[:, symbols[0]], []
        for o in symbols[1:]:
            step = best[:, None] + self.move[:N_STATES]
            back.append(step.argmax(0))
            best = step.max(0) + self.show[:, o]
        states = [last]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summary of two neighbours."""
    return (a[:, :, None] + b[None, :N_STATES]).max(1)


def _ends(summaries: list[np.ndarray], first: int, last: int) -> list[tuple[int, int]]:
    """States before and at the end of each block on the best path from ``first`` to ``last``."""
    best, back = summaries[0][first], []
    for m in summaries[1:]:
        step = best[:, None] + m[:N_STATES]
        back.append(step.argmax(0))
        best = step.max(0)
    at_end = [last]
    for came in reversed(back):
        at_end.append(int(came[at_end[-1]]))
    at_end.reverse()
    return list(zip([first, *at_end], at_end))


def _grouped(batches, *columns):
    """Rows of sorted batches by the first two columns: ``key, rows``, one group in memory at a time."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in columns)))
    return groupby(rows, key=itemgetter(0, 1))


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    """Groups of (``id``, ``block``) each in one task, in order."""
    spread = df.repartition(partitions(df.sparkSession), "id", "block")
    return spread.sortWithinPartitions("id", "block", *order)


def _in_order(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with ``rn``, their number by id, ``seq`` and a hash of the text, nulls first."""
    folder = shared_folder(rows.sparkSession, "ordered")
    return dense_index(order_rows(rows.withColumn("tie", F.xxhash64("text")), ["id", "seq", "tie"], folder, drop=["tie"]))


def _pieces(transcripts, id_col, seq_col, text_col):
    """Distinct pieces in order, in blocks of consecutive ones, whatever their numbers: none holds more than BLOCK."""
    rows = transcripts.select(
        F.col(id_col).alias("id"),
        F.col(seq_col).cast("long").alias("seq"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return _in_order(rows.distinct()).withColumn("at", F.expr(f"rn div {BLOCK}L"))


def train(labelled: DataFrame, id_col="conv_id", seq_col="turn", text_col="text", role_col="role") -> LineModel:
    """Counts of moves and symbols over transcripts whose pieces are whole turns with known roles.

    Pieces of other roles are left out. Within a piece the moves are known; between pieces the move
    is from the last state of the one before, which a join by number finds: one row meets one row, however
    many have the same place in a transcript.
    """
    set_up(labelled.sparkSession)
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.lower(role_col)).cast("int") - 1
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(seq_col).cast("long").alias("seq"), role.alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).filter("role >= 0").distinct()
    rows = _in_order(rows)

    def count(batches):
        moves, shows = {}, {}
        for batch in batches:
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                states = [2 * role] + [2 * role + 1] * text.count("\n")
                for s, line in zip(states, text.split("\n")):
                    key = (s, symbol(line))
                    shows[key] = shows.get(key, 0) + 1
                for key in zip(states, states[1:]):
                    moves[key] = moves.get(key, 0) + 1
        rows = [(0, *k, n) for k, n in moves.items()] + [(1, *k, n) for k, n in shows.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["kind", "x", "y", "n"])

    counts = rows.select("role", "text").mapInArrow(count, "kind long, x long, y long, n long")
    end = F.when(F.col("text").contains("\n"), 2 * F.col("role") + 1).otherwise(2 * F.col("role")).cast("long")
    before = rows.select((F.col("rn") + 1).alias("rn"), F.col("id").alias("id_before"), end.alias("x"))
    between = rows.select("rn", "id", (2 * F.col("role")).cast("long").alias("y")).join(before, "rn", "left")
    # The first piece opens a transcript.
    x = F.when(F.col("x").isNotNull() & F.col("id").eqNullSafe(F.col("id_before")), F.col("x")).otherwise(START)
    between = between.groupBy(x.cast("long").alias("x"), "y").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.unionByName(between.select(F.lit(0).cast("long").alias("kind"), "x", "y", "n"))
    moves, shows = {}, {}
    # At most one row per pair of states, or of state and symbol.
    for r in counts.groupBy("kind", "x", "y").agg(F.sum("n").alias("n")).collect():
        (shows if r["kind"] else moves)[r["x"], r["y"]] = r["n"]
    return LineModel(moves, shows)


def parse_transcripts(
    transcripts: DataFrame, model: LineModel, id_col: str = "conv_id", seq_col: str = "turn", text_col: str = "text"
) -> DataFrame:
    """Recovered turns: ``id_col, seq, segment, role, opens, n_lines, text, rendered``.

    A transcript is the lines of its pieces in the order of ``seq_col`` (nulls ahead; equal numbers by a
    hash of the text). It is cut into blocks by position, so its numbers need not be dense, and no block grows. A row is the part of a turn
    that lies in one piece: ``opens`` tells whether the turn begins there, and the ``rendered`` texts
    of a transcript, joined in order, are its canonical form: ``<|role|>``, a newline, the lines. The
    marker of an opening line is taken off the text.

    Pieces that repeat (same id, number and text) count once; null text is one empty line; a null id
    is a transcript like others. An empty table gives an empty result; other columns are not read.
    """
    spark = transcripts.sparkSession
    set_up(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = transcripts.schema[id_col].dataType
    pieces = _pieces(transcripts, id_col, seq_col, text_col)
    summary = f"id {id_type.simpleString()}, block long, best array<double>"
    batch_of = _batches(id_type)

    def sum_up(batches):
        def rows():
            for (key, block), group in _grouped(batches, "id", "block", "text"):
                symbols = [symbol(line) for _, _, text in group for line in text.split("\n")]
                yield key, block, shared.value.summary(symbols).ravel().tolist()

        yield from batch_of(rows(), ["best"], [pa.list_(pa.float64())])

    def merge(batches):
        def rows():
            for (key, block), group in _grouped(batches, "id", "block", "best"):
                total = None
                for _, _, best in group:
                    best = np.array(best).reshape(-1, N_STATES)
                    total = best if total is None else _joined(total, best)
                yield key, block, total.ravel().tolist()

        yield from batch_of(rows(), ["best"], [pa.list_(pa.float64())])

    up = F.floor(F.col("block") / BLOCK).cast("long")
    # Blocks are numbered over all transcripts, and then from the first one of each.
    numbered = _sorted(pieces.withColumn("block", F.col("at")), "rn").select("id", "block", "text").mapInArrow(sum_up, summary)
    numbered = store(numbered.withColumnRenamed("block", "at"), "blocks").alias("b")
    begin = numbered.groupBy("id").agg(F.min("at").alias("from")).alias("f")
    block = (F.col("at") - F.col("from")).alias("block")
    numbered = numbered.join(begin, F.col("b.id").eqNullSafe(F.col("f.id"))).select("b.id", block, "at", "best")
    levels = [store(numbered, "level")]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        below = levels[-1].select("id", up.alias("block"), F.col("block").alias("child"), "best")
        levels.append(store(_sorted(below, "child").mapInArrow(merge, summary), "level"))

    last = F.slice("best", START * N_STATES + 1, N_STATES)
    best_end = (F.array_position(last, F.array_max(last)) - 1).cast("int")
    ends = levels[-1].select("id", "block", F.lit(START).alias("first"), best_end.alias("last"))

    def descend(batches):
        columns = ["id", "block", "child", "best", "first", "last"]

        def rows():
            for (key, _), group in _grouped(batches, *columns):
                group = list(group)  # at most BLOCK
                matrices = [np.array(g[3]).reshape(-1, N_STATES) for g in group]
                for g, (a, b) in zip(group, _ends(matrices, group[0][4], group[0][5])):
                    yield key, g[2], a, b

        yield from batch_of(rows(), ["first", "last"], [pa.int32(), pa.int32()])

    for level in reversed(levels[:-1]):
        below = level.select("id", up.alias("block"), F.col("block").alias("child"), "best")
        same = below["id"].eqNullSafe(ends["id"]) & (below["block"] == ends["block"])
        joined = below.join(ends, same).select(below["id"], below["block"], "child", "best", "first", "last")
        ends = store(
            _sorted(joined, "child").mapInArrow(descend, f"id {id_type.simpleString()}, block long, first int, last int"),
            "ends",
        )

    def label(batches):
        columns = ["id", "block", "seq", "text", "first", "last"]

        def rows():
            for (key, block), group in _grouped(batches, *columns):
                group = list(group)  # the pieces of a block
                lines = [(k, line) for k, g in enumerate(group) for line in g[3].split("\n")]
                states = shared.value.path([symbol(line) for _, line in lines], group[0][4], group[0][5])
                segment = 0
                for i, (k, line) in enumerate(lines):
                    opens = states[i] % 2 == 0
                    new = i == 0 or lines[i - 1][0] != k
                    if opens or new:
                        if i:
                            yield key, block, *done
                        segment = 0 if new else segment + 1
                        done = [group[k][2], segment, ROLES[states[i] // 2], opens, 0, None]
                    text = line[marker(line)[1] :] if opens else line
                    done[4] += 1
                    done[5] = text if done[5] is None else f"{done[5]}\n{text}"
                yield key, block, *done

        types = [pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.string()]
        names = ["seq", "segment", "role", "opens", "n_lines", "text"]
        yield from batch_of(rows(), names, types)

    lowest = levels[0].select("id", "block", "at")
    same = lowest["id"].eqNullSafe(ends["id"]) & (lowest["block"] == ends["block"])
    ends = lowest.join(ends, same).select(lowest["id"], lowest["block"], "at", "first", "last")
    same = pieces["id"].eqNullSafe(ends["id"]) & (pieces["at"] == ends["at"])
    joined = pieces.join(ends, same).select(pieces["id"], "block", "seq", "rn", "text", "first", "last")
    schema = f"id {id_type.simpleString()}, block long, seq long, segment int, role string, opens boolean, n_lines int, text string"
    found = _sorted(joined, "rn").mapInArrow(label, schema)
    rendered = F.concat(
        F.when(F.col("opens"), F.concat(F.lit("<|"), "role", F.lit("|>\n"))).otherwise(""), "text", F.lit("\n")
    )
    return found.select(
        F.col("id").alias(id_col), "seq", "segment", "role", "opens", "n_lines", "text", rendered.alias("rendered")
    )


def _batches(id_type):
    """Function that packs rows of (id, block, values) into record batches."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(id_type)

    def pack(rows, names, types, size=2000):
        held = []

        def batch():
            kinds = [id_arrow, pa.int64(), *types]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["id", "block", *names])

        for row in rows:
            held.append(row)
            if len(held) >= size:
                yield batch()
                held = []
        if held:
            yield batch()

    return pack
