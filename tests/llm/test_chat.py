import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from terrace.llm.chat import format_chats
from terrace.llm.query_chat import TRICKY
from terrace.llm.templates import CHAT, Apply, Const, Output, TemplateError, compile_template, fold, parse, quote, read_back, unquote

TEXT = st.text(alphabet=st.sampled_from("<|\\>aim_startend\n \r{}%é😀"), max_size=40)


@given(TEXT)
def test_quoting_is_reversible_and_leaves_no_control_string(text):
    assert unquote(quote(text)) == text
    assert "<|" not in quote(text)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_conversations_are_read_back(turns):
    text, spans = compile_template(CHAT)({"messages": [{"role": r, "text": t} for r, t in turns]})
    assert read_back(text) == turns
    assert [unquote(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize(
    "template, values, text",
    [
        ("a{{ 'b' ~ 1 }}{# c #}", {}, "ab1"),
        ("{% if x == 1 %}one{% elif x %}some{% else %}none{% endif %}", {"x": 2}, "some"),
        ("{% for m in ms %}{{ loop.index }}{{ m.a['b'] }}{% if not loop.last %}, {% endif %}{% endfor %}", {"ms": [{"a": {"b": 1}}, {"a": {"b": 2}}]}, "11, 22"),
        ("{% set y = x + 'z' %}{{ y | upper | trim }}", {"x": " a"}, "AZ"),
        ("  {%- if true -%}  in  {%- endif -%}  out", {}, "inout"),
        ("{{ 'a' in 'abc' and not false or none }}", {}, "True"),
        ("{{ x | length }}{{ '' == x }}", {"x": ""}, "0True"),
    ],
)
def test_language(template, values, text):
    assert compile_template(template)(values)[0] == text


@pytest.mark.parametrize(
    "template", ["{{ x.__class__ }}", "{{ nothing }}", "{{ x() }}", "{% for a %}{% endfor %}", "{% if x %}", "{{ x | eval }}", "{{ 1 + }}", "{% import os %}", "{{ ' }}"]
)
def test_sandbox_and_errors(template):
    with pytest.raises(TemplateError):
        compile_template(template)({"x": 5})


def test_constants_are_folded():
    (only,) = fold(parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}"))
    assert only == Output(Const("abcd"))
    (kept,) = fold(parse("{{ x ~ ('a' ~ 'b') }}"))
    assert isinstance(kept.value, Apply) and kept.value.operands[1] == Const("ab")


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (2, None, "assistant", TRICKY), (None, 0, "a\nb\\", "c"), (3, 0, "assistant", "long " * 50000)]
    df = spark.createDataFrame(rows, "key long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    got = {r["key"]: read_back(r["formatted"]) for r in format_chats(df, "key", "turn", "role", "text").collect()}
    assert got == {
        1: [("user", ""), ("", "x"), ("", "x")], 2: [("assistant", TRICKY)], None: [("a\nb\\", "c")], 3: [("assistant", "long " * 50000)],
    }
    assert format_chats(df.limit(0), "key", "turn", "role", "text").collect() == []


def test_digest_of_the_extra_conversation(spark, sf):
    from terrace.llm.queries import QUERIES

    (r,) = QUERIES["op5_chat_formatting"](spark, sf).where("conv_id = -1").collect()
    whole = f"user\n{TRICKY}\nassistant\n{TRICKY}\n"
    assert (r["n_turns"], r["loss_chars"]) == (2, len(TRICKY))
    assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(TRICKY.encode()).hexdigest()
