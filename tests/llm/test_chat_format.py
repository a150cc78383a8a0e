import hashlib
import random

from pyspark.sql import functions as F

from chartstreak.llm import chat_format as op

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["</s>", "[INST]", "<|im_start|>user\n", "<|im_end|>\n", "&lt;", "&amp;lt;", "&#91;", "&#10;", "<<SYS>>", "\n"]


def conversations(seed=4, n=25):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 5, 40])):
            role = "system" if t == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "tool", None, "a\nb"])
            text = "".join(rng.choice([*CONTROL, "word ", "é🙂"]) for _ in range(rng.choice([0, 3, 30, 600])))
            rows.append((c, t, role, text if rng.random() < 0.95 else None))
    return rows + [(99, 0, "user", "x" * 200_000), (99, 1, "assistant", "y" * 100_000), (99, 1, "assistant", "y" * 100_000),
                   (None, None, None, None), (98, 0, "assistant", ""), (97, 3, "system", "late"), (97, 1, "user", "first")]


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, r or "", x or "") for i, t, r, x in rows if i == c))
        lined = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(lined.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tokens", "2 as `window`", "'x' as part")


def test_read_back(spark):
    rows = conversations()
    for budget, history in ((2048, 512), (300, 100), (40, 10)):
        windows = op.format_conversations(table(spark, rows), budget=budget, history=history)
        got = {r.conv_id: tuple(r)[1:5] for r in op.conversation_digests(windows).collect()}
        assert got == brute(rows)


def test_windows_keep_the_budget_and_repeat_context(spark):
    rows = conversations(8)
    windows = op.format_conversations(table(spark, rows), budget=400, history=120).withColumn(
        "turns", op.read_turns(F.col("formatted"), F.lit(0))).collect()
    system = {c: x for c, t, r, x in rows if r == "system" and t == 0}
    seen = 0
    for w in sorted(windows, key=lambda w: (str(w.conv_id), w.window)):
        new = w.turns[w.repeated:]
        assert w.n_tokens <= 400 or len(new) == 1
        if w.conv_id in system:
            assert w.turns[0].role == "system" and w.turns[0].text == (system[w.conv_id] or "")
        masked = [op_unescape(w.formatted[s.start:s.start + s.length]) for s in w.loss]
        assert masked == [t.text for t in new if t.role == "assistant"]
        seen += w.repeated
    assert seen > 0


def op_unescape(text):
    return text.replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&")


def test_control_strings_cannot_occur_in_texts(spark):
    row = op.format_conversations(table(spark, [(1, 0, "user", "".join(CONTROL)), (1, 1, "assistant", op.TRICKY)])).first()
    assert row.formatted.count("<|im_start|>") == 2 and row.formatted.count("<|im_end|>") == 2
    assert "</s>" not in row.formatted and "[INST]" not in row.formatted


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert op.conversation_digests(op.format_conversations(df)).collect() == []


def test_query_has_the_tricky_conversation(spark):
    out = {r.conv_id: r for r in op.op2_chat_format(spark, "/root/testdata/sf0.001").collect()}
    assert out[-1].n_turns == 2 and out[-1].loss_chars == len(op.TRICKY)
    assert out[-1].loss_sha256 == hashlib.sha256(op.TRICKY.encode()).hexdigest()
