"""Conversation structure repair: the cheapest edits that give each transcript a legal order of roles.

A legal transcript is nothing, or an optional system turn and then user and assistant turns in
alternation, the assistant last. A turn is kept, given another role or deleted, and empty turns
are inserted, each at a cost. A dynamic program over (turn, state of the order of roles) finds the cost
to go from every node. The arcs that lie on a cheapest path are ranked by prefix doubling: nodes
first by the least letter that leaves them, then by the least audits of 2, 4, 8 ... letters, from the rank of a
node and of the node that its doubled pointer reaches. Each node takes the arc of the least letter and
rank, and the doubled pointers list a path in as many steps as its length has bits.

Turns are numbered in one global order and cut by number, so a task never holds more than
``CHUNK`` of them, however long a conversation is. A chunk holds many whole conversations, which are decided
at once, and a piece of at most two others. A piece is first reduced to a matrix, the least cost from each
state ahead of it to each state past it. A tree of min-plus products, ``FAN`` pieces at a time, gives
the costs past each piece, and with them the piece is decided for each state ahead of it. Texts
travel apart from that and meet the edits in a pass that reads each conversation in order.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ridemetrics.llm.common import partitions, set_up, shared_folder, store
from ridemetrics.operators.frames import dense_index, order_rows

# Turns that are decided together.
CHUNK = 2048
# Pieces of a conversation whose matrices are multiplied in one step.
FAN = 256

# First letters of roles; any other one is the last number.
_INITIALS = "sua"
_OTHER = 3
# States of the order of roles: nothing yet, after the system turn, after a user's, after an assistant's.
_STATES = 4
_STEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
# The state after a turn whose role is made to fit, and that role.
_FITTED = np.array([2, 2, 3, 2])
_FITTED_ROLE = ["user", "user", "assistant", "user"]
# Cost from each state to the end of the transcript by insertions alone, and how many these are.
_INSERTED_AT_END = [0, 2, 1, 0]

# Letters of an audit in their order; an insertion consumes no turn.
LETTERS = b"DIKR"
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_COSTS = [3, 2, 0, 2]
_TRUNCATED_COST = 1
# Faults of a turn; blank and duplicate turns have to go.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_NEVER = 1 << 60


# --- turns in order, with their faults --------------------------------------------------------------


def _turns(table: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    """Four columns of the table; a null role or text is one space, as a turn without either is a turn."""
    return table.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )


def _in_order(turns: DataFrame, folder: str) -> DataFrame:
    """Stored turns with ``rn``, their number by conversation, turn, role and text, nulls first.

    Of texts of one turn and role their first characters and a digest are compared.
    """
    keys = {"_head": F.substring("text", 1, 64), "_sha": F.sha2("text", 256)}
    ordered = order_rows(turns.withColumns(keys), ["conv_id", "turn", "role", *keys], folder, drop=["_head"])
    return dense_index(ordered)


def _marked(ordered: DataFrame) -> DataFrame:
    """Stored turns without their texts: ``rn, conv_id, turn, initial, fault``."""
    rows = ordered.withColumn("blank", ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    rows = rows.select(
        "rn", "conv_id", "turn", "role", "_sha", "blank", (~end.isin(".", "!", "?")).alias("cut")
    )
    # The first of equal turns; joined by number, so that no conversation and no text is a hot key.
    firsts = rows.filter(~F.col("blank")).groupBy("conv_id", "role", "_sha").agg(F.min("rn").alias("rn"))
    marked = rows.join(firsts.select("rn", F.lit(True).alias("first")), "rn", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    letter, initial = F.substring("role", 1, 1), F.lit(_OTHER)
    for number, name in enumerate(_INITIALS):
        initial = F.when(letter == name, number).otherwise(initial)
    return store(marked.select("rn", "conv_id", "turn", initial.cast("int").alias("initial"), fault.alias("fault")), "repair-marked")


# --- the dynamic program ----------------------------------------------------------------------------


def _arcs():
    """Target state and cost by (fault, initial, state, letter); -1 where a letter does not apply."""
    target = np.full((4, 4, _STATES, 4), -1)
    cost = np.full(target.shape, _NEVER)
    for fault in range(4):
        for initial in range(4):
            for state in range(_STATES):
                ways = {_DELETE: state, _INSERT: _FITTED[state]}
                if fault not in (BLANK, DUPLICATE):
                    ways |= {_KEEP: _STEP[state, initial], _REROLE: _FITTED[state]}
                for letter, to in ways.items():
                    if to >= 0:
                        undeleted = fault == TRUNCATED and letter in (_KEEP, _REROLE)
                        target[fault, initial, state, letter] = to
                        cost[fault, initial, state, letter] = _COSTS[letter] + _TRUNCATED_COST * undeleted
    return target, cost


_TARGET, _COST = _arcs()


def _inserted(cost):
    """Costs by state (second axis) when turns may be inserted first; two are enough."""
    for _ in range(2):
        cost = np.minimum(cost, _COSTS[_INSERT] + cost[:, _FITTED])
    return cost


def costs_to_go(initial, fault, first, length, past):
    """Least cost from each node to the end of its stretch.

    Turns of all stretches stand one behind the other, stretch i from ``first[i]`` with ``length[i]``. ``past``
    (stretches x states x ends) holds the costs from there on; the result has a row per turn.
    """
    togo = np.empty((len(initial), *past.shape[1:]), np.int64)
    now = past.copy()
    for back in range(1, int(length.max(initial=0)) + 1):
        on = np.flatnonzero(length >= back)
        turn = first[on] + length[on] - back
        best = np.full((len(on), *past.shape[1:]), _NEVER)
        for letter in (_DELETE, _KEEP, _REROLE):
            to = _TARGET[fault[turn], initial[turn], :, letter]
            cost = _COST[fault[turn], initial[turn], :, letter][..., None]
            best = np.minimum(best, cost + np.take_along_axis(now[on], np.maximum(to, 0)[..., None], 1))
        best = np.minimum(_inserted(best), _NEVER)
        now[on] = best
        togo[turn] = best
    return togo


class AuditPaths:
    """Least audits along cheapest arcs, for stretches of turns decided together.

    Nodes are turn * 4 + state; behind them come four ends for each stretch.
    """

    def __init__(self, initial, fault, first, length, past):
        n, ends = len(initial), len(first)
        togo = costs_to_go(initial, fault, first, length, past[..., None])[..., 0]
        every = np.concatenate((togo.ravel(), past.ravel()))
        following = np.arange(1, n + 1)
        following[(first + length - 1)[length > 0]] = n + np.flatnonzero(length)
        state_to = _TARGET[fault, initial]  # turns x states x letters
        consumes = np.arange(4) != _INSERT
        node_to = np.where(consumes, following[:, None, None], np.arange(n)[:, None, None]) * _STATES + np.maximum(state_to, 0)
        cheapest = (state_to >= 0) & (_COST[fault, initial] + every[node_to] == togo[..., None])
        self.first, self.length, self.every, self.n = first, length, every, n
        self._rank(node_to.reshape(-1, 4), cheapest.reshape(-1, 4), n * _STATES, (n + ends) * _STATES)

    def _rank(self, node_to, cheapest, n_nodes, n_all):
        ends = np.arange(n_nodes, n_all)
        # Audits of one letter: ends have none and come first.
        letter = cheapest.argmax(1)
        rank = np.r_[letter + 1, np.zeros(len(ends), np.int64)]
        jump = np.r_[node_to[np.arange(n_nodes), letter], ends]
        self.jumps = [jump]
        while (jump < n_nodes).any():
            # Twice as many letters: the rank of the node, then that of the node so many letters on.
            rank = np.unique(rank * n_all + rank[jump], return_inverse=True)[1]
            jump = jump[jump]
            self.jumps.append(jump)
        # The arc that goes on by the least letter and the least audit behind it. From one node, arcs of one
        # letter lead to one node, so the pointers above are already those of the chosen arcs.
        order = np.where(cheapest, np.arange(4) * n_all + rank[node_to], np.iinfo(np.int64).max)
        self.letter = np.r_[order.argmin(1), np.full(len(ends), -1)]
        self.rank = rank

    def of(self, stretch: np.ndarray, state: np.ndarray):
        """Audit, state past it and cost for each (stretch, state ahead of it)."""
        at_end = (self.n + stretch) * _STATES + state
        start = np.where(self.length[stretch] > 0, self.first[stretch] * _STATES + state, at_end)
        path = start[:, None]
        for jump in self.jumps:
            path = np.concatenate((path, jump[path]), axis=1)
        last = path[:, -1]
        cost = self.every[start] - self.every[last]
        written = self.letter[path]
        letters = np.frombuffer(LETTERS, np.uint8)
        audits = [letters[row[row >= 0]].tobytes() for row in written]
        return audits, last - (self.n + stretch) * _STATES, cost


# --- chunks -----------------------------------------------------------------------------------------

# Costs from the end of a conversation.
_FINAL = np.array([_COSTS[_INSERT] * x for x in _INSERTED_AT_END])

_MORE = "rn long, chunk long, n long, codes binary, turns struct<low:long,high:long,n:long,first:long,last:long>"
_DECIDED = "audits array<binary>, past array<int>, costs array<long>"


def _pieces(marked: DataFrame) -> DataFrame:
    """A row per conversation and chunk, stored: its turns as codes, and for whole conversations the decision.

    ``matrix`` is set for the others, flattened: least cost from each state ahead of the piece to each past it.
    """
    conv = marked.schema["conv_id"].dataType
    schema = T.DataType.fromDDL(f"{_MORE}, {_DECIDED}, matrix array<long>")
    schema = T.StructType([T.StructField("conv_id", conv), *schema.fields])
    at, within = F.expr(f"rn div {CHUNK}L"), F.col("rn") % CHUNK
    # The first and the last turn of a chunk also tell the neighbours whose conversation goes on there.
    to = F.array_compact(F.array(at, F.when((within == 0) & (F.col("rn") > 0), at - 1), F.when(within == CHUNK - 1, at + 1)))
    dealt = marked.select("*", F.explode(to).alias("chunk"))

    def decide(batches):
        for chunk, table in _by_key(batches, "chunk"):
            rn = table.column("rn").to_numpy()
            own = rn // CHUNK == chunk
            if not own.any():
                continue
            ids = table.column("conv_id").to_pylist()
            new = np.array([True] + [a != b for a, b in zip(ids, ids[1:])])
            low, high = np.flatnonzero(own)[[0, -1]]
            starts = np.union1d(np.flatnonzero(new & own), low)
            ends = np.r_[starts[1:], high + 1]
            begins, stops = new[starts], np.r_[new, True][ends]
            initial, fault = table.column("initial").to_numpy(), table.column("fault").to_numpy()
            initial, fault = initial[low : high + 1], fault[low : high + 1]
            first, length = starts - low, ends - starts
            whole = np.flatnonzero(begins & stops)
            decided = {}
            if len(whole):
                past = np.tile(_FINAL, (len(whole), 1))
                paths = AuditPaths(*_cut(initial, fault, first[whole], length[whole]), past)
                answers = paths.of(np.arange(len(whole)), np.zeros(len(whole), np.int64))
                decided = {int(k): ([a], [int(s)], [int(c)]) for k, a, s, c in zip(whole, *answers)}
            turns = table.column("turn").to_pylist()
            rows = []
            for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                codes = (fault[a - low : b - low] * 4 + initial[a - low : b - low]).astype(np.uint8).tobytes()
                matrix = None
                if k not in decided:
                    alone = _cut(initial, fault, first[[k]], length[[k]])
                    togo = costs_to_go(*alone, np.where(np.eye(_STATES, dtype=bool), 0, _NEVER)[None])
                    matrix = togo[0].ravel().tolist()
                rows.append((ids[a], int(rn[a]), chunk, b - a, codes, _turn_stats(turns[a:b]), *decided.get(k, (None,) * 3), matrix))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _arrow_types(schema))], schema.names)

    spread = dealt.repartition(partitions(marked.sparkSession), "chunk").sortWithinPartitions("chunk", "rn")
    return store(spread.mapInArrow(decide, schema), "repair-pieces")


def _arrow_types(schema):
    return [to_arrow_type(f.dataType) for f in schema.fields]


def _turn_stats(turns):
    """Least, largest and distinct numbers, the first and the last; turns come in order."""
    known = [t for t in turns if t is not None]
    if not known:
        return {"low": None, "high": None, "n": 0, "first": None, "last": None}
    n = 1 + sum(a != b for a, b in zip(known, known[1:]))
    return {"low": known[0], "high": known[-1], "n": n, "first": known[0], "last": known[-1]}


def _cut(initial, fault, first, length):
    """The turns of some stretches, side by side."""
    place = np.concatenate([np.arange(a, a + n) for a, n in zip(first.tolist(), length.tolist())])
    return initial[place], fault[place], np.r_[0, np.cumsum(length)[:-1]].astype(np.int64), length


def _by_key(batches, key):
    """``(key, table)`` for each run of equal keys in sorted batches."""
    held, now = [], None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        if not len(keys):
            continue
        cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and now != keys[a]:
                yield int(now), pa.Table.from_batches(held)
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield int(now), pa.Table.from_batches(held)


# --- conversations of several pieces ---------------------------------------------------------------


def _product(left, right):
    """Min-plus product of cost matrices, or of a matrix and costs."""
    if right.ndim == 1:
        return np.minimum((left + right).min(1), _NEVER)
    return np.minimum((left[:, :, None] + right[None]).min(1), _NEVER)


def _matrix(flat):
    return np.asarray(flat, np.int64).reshape(_STATES, _STATES)


def _costs_past(pieces: DataFrame, n_chunks: int) -> DataFrame:
    """``key, place, past``: for each piece with a matrix the costs to go from its end.

    ``key`` is the number of the conversation's first turn and ``place`` counts its chunks from the first.
    """
    parts = pieces.filter("matrix IS NOT NULL")
    begin = parts.groupBy("conv_id").agg(F.min("rn").alias("key"), F.min("chunk").alias("from"))
    # One row per conversation that is cut, of which a chunk has two at most.
    parts = parts.alias("p").join(begin.alias("b"), F.col("p.conv_id").eqNullSafe(F.col("b.conv_id")))
    parts = parts.select("key", F.col("p.rn").alias("rn"), (F.col("chunk") - F.col("from")).alias("place"), "matrix", "codes")
    levels = [store(parts, "repair-parts")]
    reach = 1
    while reach < n_chunks:
        reach *= FAN
        levels.append(store(_grouped(levels[-1]), "repair-level"))
    past = levels[-1].select("key", "place", F.array(*[F.lit(int(x)) for x in _FINAL]).cast("array<long>").alias("past"))
    for level in reversed(levels[:-1]):
        past = store(_handed_down(level, past), "repair-past")
    return levels[0].join(past, ["key", "place"])


def _groups(df: DataFrame, *more):
    group = df.withColumn("group", F.expr(f"place div {FAN}L"))
    return group.repartition(partitions(df.sparkSession), "key", "group").sortWithinPartitions("key", "group", *more)


def _runs(batches):
    """Rows of sorted batches by (key, group), at most FAN of them and one more."""
    held, now = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and now != (row["key"], row["group"]):
                yield held
                held = []
            now = row["key"], row["group"]
            held.append(row)
    if held:
        yield held


def _grouped(level: DataFrame) -> DataFrame:
    """Products of up to FAN neighbouring matrices of a conversation."""

    def multiply(batches):
        for rows in _runs(batches):
            product = _matrix(rows[-1]["matrix"])
            for row in rows[-2::-1]:
                product = _product(_matrix(row["matrix"]), product)
            columns = [pa.array([x]) for x in (rows[0]["key"], rows[0]["group"])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([product.ravel().tolist()], pa.list_(pa.int64()))], ["key", "place", "matrix"])

    rows = level.select("key", "place", "matrix")
    return _groups(rows, "place").mapInArrow(multiply, "key long, place long, matrix array<long>")


def _handed_down(level: DataFrame, past: DataFrame) -> DataFrame:
    """Costs past each matrix of a level from those past its group."""

    def back(batches):
        for rows in _runs(batches):
            costs = np.asarray(rows[0]["past"], np.int64)  # the group's row comes first
            out = []
            for row in rows[:0:-1]:
                out.append((row["key"], row["place"], costs.tolist()))
                costs = _product(_matrix(row["matrix"]), costs)
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["key", "place", "past"])

    nothing = F.lit(None).cast("array<long>")
    group = past.select("key", F.col("place").alias("group"), F.lit(-1).cast("long").alias("place"), nothing.alias("matrix"), "past")
    rows = level.select("key", F.expr(f"place div {FAN}L").alias("group"), "place", "matrix", nothing.alias("past"))
    both = group.unionByName(rows).repartition(partitions(level.sparkSession), "key", "group")
    return both.sortWithinPartitions("key", "group", "place").mapInArrow(back, "key long, place long, past array<long>")


def _decided_parts(parts: DataFrame) -> DataFrame:
    """``rn`` and the decision of each piece with a matrix, for every state ahead of it."""

    def decide(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.uint8).astype(np.int64)
                length = np.array([len(codes)])
                paths = AuditPaths(codes % 4, codes // 4, np.zeros(1, np.int64), length, np.asarray(row["past"], np.int64)[None])
                audits, past, costs = paths.of(np.zeros(_STATES, np.int64), np.arange(_STATES))
                columns = [pa.array([row["rn"]]), pa.array([audits], pa.list_(pa.binary()))]
                columns += [pa.array([past.tolist()], pa.list_(pa.int32())), pa.array([costs.tolist()], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["rn", "audits", "past", "costs"])

    return parts.select("rn", "codes", "past").mapInArrow(decide, f"rn long, {_DECIDED}")


# --- edits meet the texts ---------------------------------------------------------------------------


class Repair:
    """Decided edits of all conversations; ``turns`` and ``reports`` read them together with the texts."""

    def __init__(self, conversations: DataFrame, ordered: DataFrame, pieces: DataFrame):
        self._conversations, self._ordered, self._pieces = conversations, ordered, pieces

    def _together(self) -> DataFrame:
        """Per conversation a row of its own, then each piece ahead of its turns, in order."""
        conv = self._ordered.schema["conv_id"].dataType
        pieces = self._pieces.select("conv_id", "rn", F.lit(1).alias("kind"), "n", "codes", "turns", "audits", "past", "costs")
        rows = self._ordered.select("conv_id", "rn", F.lit(2).alias("kind"), "turn", "role", "text")
        alone = self._conversations.select(F.col("conv_id").cast(conv), F.lit(-1).cast("long").alias("rn"), F.lit(0).alias("kind"))
        every = alone.unionByName(pieces, allowMissingColumns=True).unionByName(rows, allowMissingColumns=True)
        spread = every.repartition(partitions(every.sparkSession), "conv_id")
        return spread.sortWithinPartitions("conv_id", "rn", "kind")

    def turns(self) -> DataFrame:
        """``conv_id, place, edit, turn, role, text``: the repaired transcripts in order of ``place``.

        ``edit`` is the letter in the audit; an inserted turn has no ``turn`` and an empty text.
        """
        conv = self._ordered.schema["conv_id"]
        schema = T.StructType([conv, *T.DataType.fromDDL("place long, edit string, turn long, role string, text string").fields])

        def write(batches):
            types = _arrow_types(schema)
            rows, held = [], 0
            for event in _events(batches):
                if event[0] != "turn":
                    continue
                rows.append(event[1:])
                held += len(event[-1])
                if held > 1 << 20 or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)

        return self._together().mapInArrow(write, schema)

    def reports(self) -> DataFrame:
        """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
        repaired_sha256`` of the repaired ``role:text`` lines.

        The digest of a conversation needs its lines one after the other; they are read as a stream.
        """
        conv = self._ordered.schema["conv_id"]
        counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
        schema = T.StructType([conv, *T.DataType.fromDDL(counts).fields])

        def write(batches):
            types = _arrow_types(schema)
            digest, first, rows = hashlib.sha256(), True, []
            for event in _events(batches):
                if event[0] == "turn":
                    _, _, _, _, _, role, text = event
                    digest.update(b"" if first else b"\n")
                    digest.update(role + b":" + text)
                    first = False
                    continue
                rows.append((*event[1:], digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(rows) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)

        return self._together().mapInArrow(write, schema)


def _events(batches):
    """``("turn", conv_id, place, edit, turn, role, text)`` for each repaired turn, and at the end of a conversation
    ``("end", conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``; role and text as bytes."""
    open_ = None
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        kinds = columns["kind"].to_pylist()
        ids = columns["conv_id"].to_pylist()
        turn, role, text = columns["turn"].to_pylist(), columns["role"].cast(pa.binary()), columns["text"].cast(pa.binary())
        for i, kind in enumerate(kinds):
            if kind == 0:
                if open_:
                    yield from open_.end()
                open_ = _Conversation(ids[i])
            elif kind == 1:
                open_.piece({name: columns[name][i].as_py() for name in ("codes", "turns", "audits", "past", "costs")})
            else:
                yield from open_.turn(turn[i], role[i].as_py(), text[i].as_py())
    if open_:
        yield from open_.end()


class _Conversation:
    """Follows the edits of one conversation and adds up its counts, piece by piece."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.state = self.place = self.cost = self.illegal = self.distinct = 0
        self.low = self.high = self.last_turn = self.last_initial = None
        self.faults = np.zeros(4, np.int64)
        self.audits, self.letters, self.past = [], iter(()), 0

    def piece(self, row):
        """A piece begins. Its audit was chosen for the state that the pieces ahead lead to."""
        which = self.state if len(row["audits"]) > 1 else 0
        self.letters, self.audit_state = iter(row["audits"][which]), self.state
        self.audits.append(row["audits"][which])
        self.cost += row["costs"][which]
        self.state = row["past"][which]
        codes = np.frombuffer(row["codes"], np.uint8)
        self.codes = iter(codes.tolist())
        self.faults += np.bincount(codes // 4, minlength=4)
        initials = codes % 4
        if self.last_initial is not None:
            initials = np.r_[self.last_initial, initials]
        pairs = initials[:-1] * 4 + initials[1:]
        self.illegal += int((~np.isin(pairs, _LEGAL)).sum())
        self.last_initial = initials[-1]
        turns = row["turns"]
        if turns["n"]:
            self.low = turns["low"] if self.low is None else self.low
            self.high = turns["high"]
            self.distinct += turns["n"] - (self.last_turn is not None and self.last_turn == turns["first"])
            self.last_turn = turns["last"]

    def _insert(self):
        role = _FITTED_ROLE[self.audit_state].encode()
        self.audit_state = _FITTED[self.audit_state]
        self.place += 1
        return "turn", self.conv_id, self.place - 1, "I", None, role, b""

    def turn(self, turn, role, text):
        """The inserted turns ahead of this one, and what becomes of it."""
        initial = next(self.codes) % 4
        while (letter := LETTERS.index(next(self.letters))) == _INSERT:
            yield self._insert()
        if letter == _DELETE:
            return
        if letter == _REROLE:
            role = _FITTED_ROLE[self.audit_state].encode()
            self.audit_state = _FITTED[self.audit_state]
        else:
            self.audit_state = _STEP[self.audit_state, initial]
        yield "turn", self.conv_id, self.place, chr(LETTERS[letter]), turn, role, text
        self.place += 1

    def end(self):
        more = _INSERTED_AT_END[self.state]
        self.audit_state = self.state
        for _ in range(more):
            yield self._insert()
        audit = b"".join(self.audits) + b"I" * more
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        blank, duplicate, truncated = self.faults[[BLANK, DUPLICATE, TRUNCATED]].tolist()
        cost = self.cost + _COSTS[_INSERT] * more
        yield "end", self.conv_id, gaps, blank, duplicate, truncated, self.illegal, cost, audit.decode()


# Legal neighbours: system and user, user and assistant, assistant and user.
_LEGAL = [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]


def repair(
    table: DataFrame,
    conversations: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """Finds for each conversation the cheapest edits, and of these the ones with the least audit.

    Edits: keep (K, 0), give the role user or assistant (R, 2), delete (D, 3; blank and duplicate turns
    have to go), insert an empty user or assistant turn anywhere (I, 2); a truncated turn that stays
    costs 1 more. A turn is blank without a character other than white space, a duplicate if the conversation
    has its role and text before, truncated if its last such character is not one of ``.!?``; the first
    that applies counts.

    Turns are taken by number, nulls first; equal numbers by role, then text. A null role or text is one
    space, a null ``conv_col`` a conversation like others. ``conversations`` names further conversations, which may
    have no turns: their reports are zeros and an empty audit. An empty table gives an empty result; other columns
    are not read.
    """
    set_up(table.sparkSession)
    folder = shared_folder(table.sparkSession, "repair-ordered")
    ordered = _in_order(_turns(table, conv_col, turn_col, role_col, text_col), folder)
    marked = _marked(ordered)
    n_turns = marked.count()
    pieces = _pieces(marked)
    decided = _decided_parts(_costs_past(pieces, -(-n_turns // CHUNK)))
    whole = pieces.filter("matrix IS NULL")
    cut = pieces.filter("matrix IS NOT NULL").drop("audits", "past", "costs").join(decided, "rn")
    pieces = store(whole.unionByName(cut).drop("matrix", "chunk"), "repair-decided")
    named = table.select(F.col(conv_col).alias("conv_id"))
    if conversations is not None:
        named = named.union(conversations.select(F.col(conv_col)))
    return Repair(named.distinct(), ordered.drop("_sha"), pieces)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by the checksum of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops the turn,
    1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes its role user."""

    def known(name) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    role = F.when(kind == 4, "user").otherwise(known("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_times"))
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("_times", "_copy")
