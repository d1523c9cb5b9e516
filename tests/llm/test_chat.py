import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemetrics.llm import chat
from ridemetrics.llm.chat import N_STATES, ROLES, START, LineModel, marker, parse_transcripts, symbol, train
from ridemetrics.llm.queries import raw_transcripts

SCHEMA = "conv_id long, turn long, role string, text string"


def _plain_path(model, symbols):
    """Best score of the whole sequence, and the score of a given path."""
    best = model.move[START] + model.show[:, symbols[0]]
    for o in symbols[1:]:
        best = (best[:, None] + model.move[:N_STATES]).max(0) + model.show[:, o]
    return best.max()


def _score(model, symbols, states):
    total, before = 0.0, START
    for s, o in zip(states, symbols):
        total += model.move[before, s] + model.show[s, o]
        before = s
    return total


def _conversations(seed, turns):
    rng = random.Random(seed)
    names = {"user": ["User: ", "Q: ", ""], "assistant": ["AI: ", "Bot> ", ""], "system": ["System: "]}
    rows = []
    for conv, n in enumerate(turns):
        for t in range(n):
            role = "system" if t == 0 and rng.random() < 0.5 else ["user", "assistant"][t % 2]
            lines = ["w " * rng.randrange(1, 200) + rng.choice(["?", "."]) for _ in range(rng.randrange(1, 4))]
            rows.append((conv, t, role, rng.choice(names[role]) + "\n".join(lines)))
    return rows


@pytest.mark.parametrize("block", [2, 3, 64])
def test_blocks_give_a_best_path(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = _conversations(block, [1, 2, 40, 7])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = train(docs)
    found = parse_transcripts(docs, model).collect()
    for conv in {r[0] for r in rows}:
        lines = [line for r in sorted(r for r in rows if r[0] == conv) for line in r[3].split("\n")]
        symbols = [symbol(line) for line in lines]
        states = []
        for r in sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.seq, r.segment)):
            role = 2 * ROLES.index(r.role)
            states += [role if r.opens else role + 1] + [role + 1] * (r.n_lines - 1)
        assert len(states) == len(lines)
        assert _score(model, symbols, states) == pytest.approx(_plain_path(model, symbols))


def test_accuracy_on_held_out_conversations(spark):
    raw = raw_transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).persist()
    held = F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(5)) == 0
    model = train(raw.filter(~held))
    found = parse_transcripts(raw.filter(held), model).filter("segment = 0").select("conv_id", F.col("seq").alias("turn"), F.col("role").alias("got"))
    right = raw.join(found, ["conv_id", "turn"]).agg(F.avg((F.col("role") == F.col("got")).cast("int"))).first()[0]
    assert right > 0.9


def test_markers():
    assert [marker(x)[0] for x in ["User: hi", "[AI] yes", "### System:", "Bob: x", "so it is", "A > b", "12:30", "**Human:** x"]] == [2, 3, 1, 4, 0, 0, 0, 2]
    assert "User: hi"[marker("User: hi")[1] :] == "hi"


def test_rendering_and_edges(spark):
    rows = [
        (1, 0, "user", "User: hello"), (1, 0, "user", "User: hello"), (1, 1, "assistant", "AI: yes\nmore"),
        (None, 5, "user", "Q: what?"), (2, None, "user", None), (3, -4, "nobody", ""), (3, 9**9, "user", "User: late"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit(1), "segment": F.lit("x"), "id": F.lit(0)})
    model = train(spark.createDataFrame(_conversations(1, [6] * 80), SCHEMA))
    found = sorted(parse_transcripts(docs, model).collect(), key=lambda r: (r.conv_id or 0, r.seq or 0, r.segment))
    by_id = {}
    for r in found:
        by_id.setdefault(r.conv_id, []).append(r)
    assert "".join(r.rendered for r in by_id[1]) == "<|user|>\nhello\n<|assistant|>\nyes\nmore\n"
    assert by_id[None][0].rendered == "<|user|>\nwhat?\n"
    assert [r.text for r in by_id[2]] == [""]
    assert [r.seq for r in by_id[3]] == [-4, 9**9]
    assert parse_transcripts(docs.limit(0), model).count() == 0
    assert isinstance(train(docs.limit(0)), LineModel) and np.isfinite(model.show).all()


def test_many_pieces_with_one_number_are_cut_by_position(spark, monkeypatch):
    """A transcript whose turns are all null, negative or tied: blocks of a few pieces, and still a best path."""
    monkeypatch.setattr(chat, "BLOCK", 4)
    rng = random.Random(8)
    rows = [(1, rng.choice([None, -5, 3]), "user", f"{rng.choice(['User', 'AI', 'Q'])}: line {i}") for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = train(spark.createDataFrame(_conversations(2, [6] * 60), SCHEMA))
    pieces = chat._pieces(docs, "conv_id", "turn", "text")
    assert max(r["count"] for r in pieces.groupBy("at").count().collect()) <= 4
    ordered = [r.text for r in pieces.orderBy("rn").collect()]
    found = parse_transcripts(docs, model)
    states = {r.text: 2 * ROLES.index(r.role) + (not r.opens) for r in found.collect()}
    symbols = [symbol(t) for t in ordered]
    best = [states.get(t, states.get(t[marker(t)[1] :])) for t in ordered]
    assert None not in best and _score(model, symbols, best) == pytest.approx(_plain_path(model, symbols))


def test_training_counts_each_neighbour_once(spark):
    """Equal numbers make no pairs: n pieces have n - 1 moves between them, and one that opens."""
    rows = [(1, 0, ["user", "assistant"][i % 2], f"t{i}") for i in range(200)] + [(2, 7, "user", "x"), (2, 90, "assistant", "y")]
    seen = []
    real = chat.LineModel
    train_with = lambda moves, shows: seen.append(moves) or real(moves, shows)
    original, chat.LineModel = chat.LineModel, train_with
    try:
        train(spark.createDataFrame(rows, SCHEMA).repartition(3))
    finally:
        chat.LineModel = original
    moves = seen[0]
    assert sum(n for (x, _), n in moves.items() if x == START) == 2
    assert sum(n for (x, y), n in moves.items() if x != START and y % 2 == 0) == 199 + 1


def test_a_very_long_text(spark):
    text = "User: hi\n" + "a line of words\n" * 50_000
    model = train(spark.createDataFrame(_conversations(3, [6] * 40), SCHEMA))
    found = parse_transcripts(spark.createDataFrame([(1, 0, "user", text)], SCHEMA), model)
    assert found.agg(F.sum("n_lines")).first()[0] == 50_002
