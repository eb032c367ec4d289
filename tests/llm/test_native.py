"""Chat formatting and quality rules against plain Python."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from snapwatch.llm import chat, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, formatted string, turns string"


def chats(spark, rows):
    """Rows of turns, with two columns named like results."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def test_hostile_texts_come_back(spark):
    pieces = ["[INST]", "[/INST]", " [/INST]\n", "<s>", "</s>", "<<SYS>>", " <</SYS>>\n", "<<ROLE>>", "<<TEXT>>", "<", "[", "\\", " ", "\n", "é", "ok", "/s>", "INST]", "$1"]
    pick = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "<<TEXT>>", "a <s> b", ""]
    rows = [
        (conv, turn, pick.choice(roles), "".join(pick.choice(pieces) for _ in range(pick.randrange(9))))
        for conv in range(150)
        for turn in range(pick.randrange(1, 6))
    ]
    got = {r.conv_id: r for r in chat.format_chats(chats(spark, rows)).collect()}
    for conv in range(150):
        mine = [(r[2], r[3]) for r in rows if r[0] == conv]
        row = got[conv]
        assert row.round_trip and [(t.role, t.text) for t in row.turns] == mine
        assert "".join(s.text for s in row.segments) == row.formatted
    # No control string of a text stands unescaped in the output.
    read = chat.format_chats(chats(spark, rows)).select("conv_id", chat.parse_chat(F.col("formatted")).alias("t")).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.t] for r in read} == {
        conv: [(r[2], r[3]) for r in rows if r[0] == conv] for conv in range(150)
    }


def test_chat_nulls_ties_long_and_empty(spark):
    long = "word [INST] " * 20_000
    rows = [
        (1, 1, "user", None),
        (1, 2, None, "b"),
        (1, 2, "assistant", "a"),
        (1, 2, "assistant", "a"),
        (1, None, "system", ""),
        (None, 0, "user", "lost"),
        (2, 0, "assistant", long),
    ]
    got = {r.conv_id: r for r in chat.format_chats(chats(spark, rows)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("system", ""), ("user", ""), ("", "b"), ("assistant", "a"), ("assistant", "a")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "lost")]
    assert got[2].turns[0].text == long and all(r.round_trip for r in got.values())
    assert chat.format_chats(chats(spark, [])).collect() == []


def test_query_reads_control_strings_back(spark):
    from snapwatch.llm.queries import QUERIES

    row = QUERIES["op1_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars, row.round_trip) == (2, len(text), True)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def counted(text):
    """The counts of a text by plain loops."""
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


DOCS = "doc_id long, text string, n_words string, _text string, failed string"


def test_quality_counts(spark):
    pick = random.Random(3)
    texts = [None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "x " * 500, "é ß # $ |\nline\nline\n\n line", "a b c\x1cd", "a\x0bb\x0cc\rd\r\n"]
    texts += [" ".join(pick.choice("abcde") for _ in range(n)) for n in (10, 60, 200, 3000)]
    texts += [" ".join(f"w{pick.randrange(400)}" for _ in range(n)) for n in (100, 1000, 5000)]
    texts.append("\n".join(pick.choice(["one two", "three", "...", "- x"]) for _ in range(300)))
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in quality.quality_verdicts(docs).collect()}
    for i, text in enumerate(texts):
        row = got[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counted(text), text
        assert row.kept == (not row.failed) and (row.n_words >= 50 or "few_words" in row.failed)


def test_quality_keeps_rows_and_columns(spark):
    good = " ".join(f"the word{i} of" for i in range(60))
    rows = [(1, good, "x", "y", "z"), (1, good, "x", "y", "z"), (None, good, None, None, None), (2, "bad", "x", "y", "z"), (3, None, "x", "y", "z")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=repr) == sorted(docs.limit(3).collect(), key=repr)
    assert quality.keep_good(docs.limit(0)).collect() == [] and quality.quality_verdicts(docs.limit(0)).collect() == []
    # A filter on the verdict must not repeat the work of the projections below it.
    assert quality.quality_verdicts(docs).where("kept").count() == 3


def test_a_rule_of_the_table_can_be_left_out(spark):
    docs = spark.createDataFrame([(1, "too few words", "x", "y", "z")], DOCS)
    rules = tuple(r for r in quality.RULES if r.name not in ("few_words", "stop_words"))
    assert quality.quality_verdicts(docs, rules).first().failed == []
