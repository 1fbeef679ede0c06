import numpy as np
from pyspark.sql import functions as F

from tallyweir.llm import transcripts
from tests.llm.common import empty, sentence

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def conversations(spark, n, turns, start=0):
    rows = []
    for c in range(start, start + n):
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            lines = [sentence(c * 100 + t * 7 + k, 5 if role == "user" else 40) for k in range(1 if role == "user" else 3)]
            rows.append((c, t, role, "\n".join(lines) + ("?" if role == "user" else "")))
    return spark.createDataFrame(rows, CONVERSATIONS)


def viterbi(model, symbols):
    """The textbook form, over one whole sequence."""
    scores, back = model["start"] + model["emission"][:, symbols[0]], []
    for s in symbols[1:]:
        step = scores[:, None] + model["moves"]
        back.append(step.argmax(axis=0))
        scores = step.max(axis=0) + model["emission"][:, s]
    path = [int(scores.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], float(scores.max())


def score(model, symbols, path):
    total = model["start"][path[0]] + model["emission"][path[0], symbols[0]]
    for a, b, s in zip(path, path[1:], symbols[1:]):
        total += model["moves"][a, b] + model["emission"][b, s]
    return float(total)


def test_blocks_give_a_best_path_of_every_conversation(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "BLOCK", 7)
    table = conversations(spark, 6, 9).unionByName(conversations(spark, 1, 120, start=50))
    lines = transcripts.numbered_lines(transcripts.raw_transcripts(table))
    model = transcripts.fit(lines)
    rows = lines.join(transcripts.recover_states(lines, model), "rank").orderBy("rank").collect()
    assert len(rows) == lines.count()
    for conv in {r["conv_id"] for r in rows}:
        own = [r for r in rows if r["conv_id"] == conv]
        symbols = [r["symbol"] for r in own]
        assert np.isclose(score(model, symbols, [r["state"] for r in own]), viterbi(model, symbols)[1])


def test_roles_are_recovered_on_conversations_not_fitted(spark):
    model = transcripts.fit(transcripts.numbered_lines(transcripts.raw_transcripts(conversations(spark, 40, 6))))
    lines = transcripts.numbered_lines(transcripts.raw_transcripts(conversations(spark, 30, 6, start=1000)))
    states = lines.join(transcripts.recover_states(lines, model), "rank")
    right = F.get(F.array(*map(F.lit, transcripts.ROLES)), F.floor(F.col("state") / 2).cast("int")) == F.col("role")
    assert states.agg(F.avg(right.cast("int"))).first()[0] > 0.9


def test_rendered_turns_keep_every_line_without_its_marker(spark):
    table = conversations(spark, 8, 5)
    turns = transcripts.recovered_turns(transcripts.raw_transcripts(table)).collect()
    for conv in range(8):
        own = sorted((t for t in turns if t["conv_id"] == conv), key=lambda t: t["line"])
        assert own[0]["line"] == 0
        body = "\n".join(t["rendered"].split("\n", 1)[1].removesuffix("\n") for t in own)
        texts = [r["text"] for r in table.filter(F.col("conv_id") == conv).orderBy("turn").collect()]
        assert body == "\n".join(texts)
        assert all(t["rendered"].startswith(f"<|{t['role']}|>\n") for t in own)


def test_no_text_is_lost_or_forged(spark):
    """Marker-like and header-like lines inside turns stay; speaker and unescaped body give back every line."""
    model = transcripts.fit(transcripts.numbered_lines(transcripts.raw_transcripts(conversations(spark, 40, 6))))
    inside = ["Context: this line matters", "# Answer", "A: choose option a", "<|user|>", "x <|system|> y <\\\\|assistant|>", "", " "]
    long = [sentence(k, 40) for k in range(5)]
    texts = [["System: " + long[0], *long[1:3]], ["User: " + sentence(9, 5) + "?"], ["Assistant: " + long[3], long[4]]]
    texts += [[*inside, "word " * 50_000], ["plain"]]
    rows = [(c, n, line, "clash") for c in (None, 1, 2) for n, line in enumerate(sum(texts, []))]
    extra = "block string, symbol string, rank string, _turn string, state string, speaker string"
    raw = spark.createDataFrame([r[:3] + (r[3],) * 6 for r in rows], f"conv_id long, pos long, line string, {extra}")
    turns = transcripts.recovered_turns(raw, model).withColumn(
        "body", transcripts.unescaped(F.expr("substr(rendered, length(role) + 6, length(rendered) - length(role) - 6)"))
    )
    found = turns.orderBy("conv_id", "line").collect()
    for conv in (None, 1, 2):
        own = [t for t in found if t["conv_id"] == conv]
        assert "\n".join(t["speaker"] + t["body"] for t in own) == "\n".join(line for line in sum(texts, []))
    for t in found:
        headers = [r for r in transcripts.ROLES for _ in range(t["rendered"].count(f"<|{r}|>"))]
        assert headers == [t["role"]]
    top = next(t for t in found if t["conv_id"] == 1 and t["line"] == 0)
    assert top["speaker"] == "System: " and top["rendered"].startswith(f"<|{top['role']}|>\n{long[0]}\n")


def test_the_model_is_fitted_to_half_and_judged_on_the_other(spark):
    raw = transcripts.raw_transcripts(conversations(spark, 80, 6))
    turns = transcripts.recovered_turns(raw, fit_on=~transcripts.held_out(F.col("conv_id")))
    seen = transcripts.role_accuracy(turns, raw).first()
    kept = raw.filter("begins").filter(transcripts.held_out(F.col("conv_id"))).count()
    assert 0 < seen["n_turns"] == kept < raw.filter("begins").count()
    assert seen["accuracy"] > 0.9


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", ""), (1, 1, "user", "x"), (1, 1, "user", "x"), (1, None, "other", "y\nz")]
    rows += [(2, t, "user", "a: b") for t in range(3)]
    turns = transcripts.recovered_turns(transcripts.raw_transcripts(spark.createDataFrame(rows, CONVERSATIONS))).collect()
    assert sum(t["n_lines"] for t in turns) == 9
    none = spark.createDataFrame([(1, 1, None, "x"), (1, 2, None, "y")], CONVERSATIONS)
    assert sum(t["n_lines"] for t in transcripts.recovered_turns(transcripts.raw_transcripts(none)).collect()) == 2
    assert transcripts.recovered_turns(transcripts.raw_transcripts(empty(spark, CONVERSATIONS))).count() == 0
