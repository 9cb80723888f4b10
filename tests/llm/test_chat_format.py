from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import differences
from pyspark.sql import functions as F

from corpusloom.llm import chat_format
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import op12_formatted_chats

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = ["<s>", "</s>", "</s>\n", "[INST] ", " [/INST]\n", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "\\", "<", "[", "s>", "/", "\n", "é🙂", "INST]"]


def plain(rows):
    found = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for key, _, role, text in order:
        found.setdefault(key, []).append((role or "", text or ""))
    return {
        key: (turns, "".join(t for role, t in turns if role == "assistant"), len(list(groupby(turns, lambda t: t[0]))))
        for key, turns in found.items()
    }


def _found(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    # Other columns with the names that the operator uses itself.
    turns = turns.select("*", *[F.lit("x").alias(c) for c in ("key", "turns", "firsts", "blocks", "pieces", "entry", "formatted")])
    found = chat_format.read_back(chat_format.format_conversations(turns)).collect()
    assert len({r["key"] for r in found}) == len(found)
    return {r["key"]: r for r in found}


def _check(spark, rows):
    found, expected = _found(spark, rows), plain(rows)
    assert found.keys() == expected.keys()
    for key, (turns, loss, blocks) in expected.items():
        r = found[key]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss_text"] == loss
        assert r["n_blocks"] == blocks
        # One head and one end per block, and no control string but marks.
        assert r["formatted"].count("[INST]") == r["formatted"].count("[/INST]") == r["formatted"].count("</s>") == blocks
        assert r["formatted"].count("<s>") == len(turns)
    return found


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, -1, 1, 2]),
            st.sampled_from([None, 0, 1, 2, 3]),
            st.sampled_from([None, "user", "assistant", "tool <s>[/INST]\n"]),
            st.one_of(st.none(), st.lists(st.sampled_from(MARKS), max_size=6).map("".join)),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_every_turn_and_the_mask_come_back(spark, rows):
    _check(spark, rows)


def test_merging_ties_repeats_and_long_texts(spark):
    long = "é🙂<s>" * 50_000
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (1, 2, "assistant", long), (1, 3, "assistant", "")]
    rows += [(1, 4, "assistant", "end"), (2, 0, "assistant", None), (None, None, None, None)]
    rows += [(3, i, "user" if i % 3 else "assistant", f"turn {i}") for i in range(500)]
    found = _check(spark, rows)
    assert found[1]["formatted"].startswith("<s>[INST] user [/INST]\na<s>b<s>b</s>\n<s>[INST] assistant [/INST]\né🙂<\\s>")
    assert [p.end - p.start for p in found[1]["loss"]] == [len(long) + 50_000, 0, 3]


def test_mask_places_hold_the_assistants_text(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a</s>b"), (1, 2, "user", "x"), (1, 3, "assistant", "c")]
    r = _found(spark, rows)[1]
    assert [r["formatted"][p.start : p.end] for p in r["loss"]] == ["a<\\/s>b", "c"]


def test_empty_table(spark):
    found = chat_format.format_conversations(spark.createDataFrame([], SCHEMA))
    assert chat_format.read_back(found).count() == 0


def test_only_expressions(spark, small_dir):
    plan = op12_formatted_chats(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_sql(spark, small_dir, tmp_path, extra):
    if extra:
        rows = [(1, 0, "user", "a<s>"), (1, 1, "user", None), (2, 0, "assistant", "x[/INST]\n"), (2, 1, "assistant", "<\\s>")]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "parts"))
        (next((tmp_path / "parts").glob("*.parquet"))).rename(tmp_path / "conversations.parquet")
        small_dir = str(tmp_path)
    assert differences(op12_formatted_chats(spark, small_dir), ORACLES["op12_formatted_chats"], small_dir) == []
