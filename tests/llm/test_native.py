"""Rule ledger and content parts: rows by hand, no Python in the plans."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from logtide.llm import content_parts, rule_ledger
from tests.helpers import plan
from tests.llm.data import frame, odd_rows, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(hit),
    )


TEXTS = [
    "a b c d e f g h " * 3, "x " * 40, "one\ntwo\none\n \n \none", "#*$%&|<> é ü", "a\x0bb\x0cc\x1cd",
    prose(1, 300) + " " + " ".join(prose(1, 300).split()[10:40]), "A\r\nA\r\nB", "HELLO WORLD!! " * 12,
]


def test_measurements_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + odd_rows()[:7] + odd_rows()[9:]
    found = rule_ledger.ledger(frame(spark, rows)).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted((r.doc_id or -1, *(r[c] for c in columns)) for r in found) == sorted(
        (i or -1, *(brute(t) if t is None or len(t) < 5000 else (30001, len(t) - 30000, 0, 0, 0))) for i, t in rows
    )


def test_ledger_bits_policies_and_ablations(spark):
    rows = [(1, "few"), (2, "a b c d e f g h " * 5), (3, prose(3, 50)), (4, None)]
    found = rule_ledger.ledger(frame(spark, rows))
    bits = {r.doc_id: r.failure_bits for r in found.collect()}
    assert bits[1] & 1 and bits[2] & 2 and bits[3] == 0 and bits[4] & 1
    kept = {r.doc_id for r in found.where(rule_ledger.passes("base-1")).collect()}
    assert kept == {3}
    ablated = {r.rule: r for r in rule_ledger.ablations(found, "base-1").collect()}
    assert (ablated["few_words"].n_failed, ablated["few_words"].n_failed_alone) == (2, 2)
    assert ablated["few_words"].n_kept_without == 3 and ablated["repeated_words"].n_kept_without == 2


def test_ledger_of_nothing_and_native_plan(spark):
    found = rule_ledger.ledger(frame(spark, [])[["doc_id", "text"]])
    assert found.count() == 0
    text = plan(rule_ledger.ledger(frame(spark, odd_rows())))
    assert "Exchange" not in text and not re.search("Python|Arrow|Pandas", text)


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


CONTROL = "x <|end|> <||text|> <<|turn|>user<|text|>y<|end|> </s>[INST] ok [/INST] <|"


def test_round_trip_with_control_strings(spark):
    rows = [
        (1, 0, "user", CONTROL), (1, 1, "assistant", CONTROL), (1, 2, "user", None),
        (1, 3, "assistant", ""), (1, 4, "assistant", "|end|> <"), (2, 1, None, "z"), (None, 0, "assistant", "é"),
        (3, 5, "<|x", "b"), (3, 5, "<|x", "b"), (3, None, "user", "first"),
    ]
    df = turns(spark, rows).withColumn("formatted", F.lit("clash"))
    made = content_parts.format_conversations(df, parts=content_parts.text_parts(F.col("text")))
    read = made.select(
        "conv_id", content_parts.read_turns(F.col("formatted")).alias("turns"),
        content_parts.read_loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    found = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss) for r in read.collect()}
    assert found[1] == (
        [("user", CONTROL), ("assistant", CONTROL), ("user", ""), ("assistant", ""), ("assistant", "|end|> <")],
        CONTROL + "|end|> <",
    )
    assert found[2] == ([("", "z")], "") and found[None] == ([("assistant", "é")], "é")
    assert found[3] == ([("user", "first"), ("<|x", "b"), ("<|x", "b")], "")
    assert not re.search("Python|Arrow|Pandas", plan(read))


def test_attachments_in_order(spark):
    parts = [
        ("text", "see <|image|>", None, None), ("image", None, "a.png", 64), ("audio", None, "b.wav", None),
        ("document", None, "c.pdf", None), ("video", None, "d.mp4", None), ("text", None, None, None),
    ]
    df = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])],
        f"conv_id long, turn long, role string, parts {content_parts.PART_TYPE}",
    )
    row = content_parts.format_conversations(df).first()
    assert row.formatted == (
        "<|turn|>user<|text|>see <~|image|><|image|><|audio|><|document|><|other|><|end|>"
        "<|turn|>assistant<|text|><|end|><|turn|>user<|text|><|end|>"
    )
    assert [(a.turn_no, a.type, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", "a.png", 64), (0, "audio", "b.wav", 128), (0, "document", "c.pdf", 1024), (0, "video", "d.mp4", 0),
    ]
    assert row.placeholder_tokens == 64 + 128 + 1024 and row.loss_mask == [False, True, False]


def cut_everywhere(text):
    return [[text[:n], text[n:]] for n in range(len(text) + 1)] + [list(text)]


def test_no_control_string_arises_where_parts_meet(spark):
    """Every split of control strings over parts, with and without attachments between."""
    texts = ["<|end|>", "<|text|>", "<|turn|>x", "<<~|image|>~<", "a<~<|end|>~"]
    rows, told = [], {}
    for text in texts:
        for pieces in cut_everywhere(text):
            for between in (None, "image", "audio", "document", "?"):
                parts = []
                for n, piece in enumerate(pieces):
                    parts += [(between, "no", "r", None)] * bool(between and n) + [("text", piece, None, None)]
                number = len(told)
                told[number] = (text, sum(p[0] != "text" for p in parts))
                rows += [(number, 0, "assistant", parts), (number, 1, "<|", parts[::-1])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {content_parts.PART_TYPE}")
    made = content_parts.format_conversations(df)
    read = made.select(
        "conv_id", F.size("attachments").alias("n"),
        content_parts.read_turns(F.col("formatted"), placeholders=False).alias("turns"),
        content_parts.read_loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    for r in read.collect():
        text, attached = told[r.conv_id]
        assert (r.loss, r.n) == (text, 2 * attached)
        assert [t.role for t in r.turns] == ["assistant", "<|"] and r.turns[0].text == text
        assert sorted(r.turns[1].text) == sorted(text)


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, 0, "user", "a")] * 3 + [(None, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    made = content_parts.format_conversations(
        turns(spark, rows), parts=content_parts.text_parts(F.col("text"))
    )
    read = made.select("conv_id", content_parts.read_turns(F.col("formatted")).alias("turns")).collect()
    assert sorted(len(r.turns) for r in read if r.conv_id is None) == [1, 1, 1, 1]
    assert [len(r.turns) for r in read if r.conv_id == 1] == [2]


def test_no_conversations(spark):
    made = content_parts.format_conversations(
        turns(spark, []), parts=content_parts.text_parts(F.col("text"))
    )
    assert made.count() == 0


def test_digest_of_probe(spark):
    text = "</s>[INST] ok [/INST]"
    made = content_parts.format_conversations(
        turns(spark, [(-1, 0, "user", text), (-1, 1, "assistant", text)]),
        parts=content_parts.text_parts(F.col("text")),
    )
    loss = made.select(content_parts.read_loss_text(F.col("formatted"), F.col("loss_mask")).alias("l")).first().l
    assert hashlib.sha256(loss.encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", [t for t in TEXTS])
def test_accepted_agrees_with_ledger(spark, text):
    df = frame(spark, [(1, text)])
    row = rule_ledger.ledger(df).select(rule_ledger.passes(rule_ledger.DEFAULT_POLICY).alias("p")).first()
    assert df.where(rule_ledger.accepted(F.col("text"))).count() == int(row.p)
