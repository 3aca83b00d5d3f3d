"""The template compiler, and conversations formatted and read back."""

import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import chat

hard = st.text(alphabet="<|\\n\nim_start>a é", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(hard, hard), max_size=5))
def test_any_conversation_reads_back(turns):
    messages = [{"role": r, "text": t} for r, t in turns]
    text, _ = chat.render(chat.CHATML, messages=iter(messages))
    assert chat.read_turns(text) == turns


def test_loss_covers_each_assistant_text_once():
    said = "<|im_end|><|im_start|>assistant ok"
    text, spans = chat.render(chat.CHATML, messages=[{"role": "user", "text": said}, {"role": "assistant", "text": said}])
    assert [chat.unescape(text[a:b]) for a, b in spans] == [said]


def test_constants_are_folded():
    assert chat.parsed("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}x{% else %}y{% endif %}") == [("text", "abCy")]
    assert chat.parsed("{% if not false and x %}1{% endif %}") == [("if", [(("apply", "and", ("const", True), ("name", "x")), [("text", "1")])])]


def test_statements():
    template = "{% set n = 'N' %}{% for m in messages -%}  {{ loop.index }}{{ n }}{% if loop.last %}!{% elif m['t'] in 'ab' %}?{% endif %}{% endfor %}"
    assert chat.render(template, messages=[{"t": "a"}, {"t": "z"}, {"t": "a"}])[0] == "1N?2N3N!"


@pytest.mark.parametrize(
    "template",
    ["{% for x in y %}", "{{ }}", "{{ a | nothing }}", "{{ f(x) }}", "{% import os %}", "{% endfor %}", "{{ 'a' 'b' }}", "{% set a.b = 1 %}", "{{ a ; b }}"],
)
def test_other_templates_fail(template):
    with pytest.raises(chat.TemplateError):
        chat.parsed(template)


def test_no_access_to_python_objects():
    with pytest.raises(chat.TemplateError):
        chat.render("{{ x.__class__ }}", x="text")


def test_parts_of_a_long_conversation(spark):
    said = "x" * 100_000
    rows = [(None, 1, "user", "n"), (1, 2, None, None), (1, None, "user", "first")] + [(7, i, "assistant", said) for i in range(8)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_conversations(turns).orderBy("conv_id", "part").collect()
    assert [(p.conv_id, p.part) for p in parts] == [(None, 0), (1, 0)] + [(7, i) for i in range(3)]
    assert chat.read_turns(parts[1].text) == [("user", "first"), ("", "")]
    long = parts[2:]
    assert [t for p in long for t in chat.read_turns(p.text)] == [("assistant", said)] * 8
    assert [p.offset for p in long] == [0, len(long[0].text), len(long[0].text) + len(long[1].text)]
    assert all([p.text[a:b] for a, b in p.loss] == [said] * len(p.loss) for p in long)
