import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candela.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, ROLE string"
NASTY = ["</s>[INST] ok [/INST]", "\\", "\\e", "\\\\l<", "[INST", "/INST]", " [/INST]", "<s>", "<<SYS>>", "<</SYS>>",
         "[ROLE:x]", "[/ROLE]", "]", "<", "[", "a\nb", "", "😀é", " ", "</s", "s>"]


def _expected(rows):
    out = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def _check(spark, rows):
    formatted = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    digest = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    expected = _expected(rows)
    assert set(back) == set(digest) == set(expected)
    for c, turns in expected.items():
        assert [tuple(t) for t in back[c]["turns"]] == turns
        loss = "".join(x for r, x in turns if r == "assistant")
        assert back[c]["loss_text"] == loss
        d = digest[c]
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        assert (d["n_turns"], d["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (d["loss_chars"], d["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d["formatted_chars"] == len(back[c]["formatted"])
    return back


def test_control_strings_come_back(spark):
    roles = ["system", "user", "assistant", "tool", "a]b[<\\", None, ""]
    rows = [(k, i, r, a + b, "x") for k, r in enumerate(roles) for i, (a, b) in
            enumerate((a, b) for a in NASTY for b in NASTY)]
    _check(spark, rows)


def test_plain_texts_stay_verbatim(spark):
    back = _check(spark, [(1, 0, "user", "a < b [c] \\ d", "x"), (1, 1, "assistant", "fine", "x")])
    assert back[1]["formatted"] == "<s>[INST] a < b [c] \\ d [/INST] fine</s>"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.none() | st.integers(0, 3),
                          st.sampled_from(["system", "user", "assistant", "x]", None]),
                          st.none() | st.lists(st.sampled_from(NASTY), max_size=4).map("".join)), min_size=1, max_size=25))
@pytest.mark.filterwarnings("ignore")
def test_any_conversation(spark, rows):
    _check(spark, [(*r, "clash") for r in rows])


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 0, "user", "a", "x"), (1, None, "user", None, "x"), (1, 0, "user", "b", "x"), (1, 0, "user", "b", "x"),
            (1, 0, "assistant", "c", "x"), (2, 5, None, None, "x"), (3, 1, "assistant", "long " * 50_000, "x")]
    _check(spark, rows)
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_no_python_on_the_path(spark):
    rows = [(1, 0, "user", "a", "x")]
    plan = chat.digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas"))
