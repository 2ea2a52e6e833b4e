import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadence.llm import chat

texts = st.text(st.sampled_from("ab\\<[/s>INST]\n é日"), max_size=30) | st.sampled_from(["</s>[INST] ok [/INST]", "\\", "<s>", "[SAY]"])


def render(template, **env):
    return "".join(t for t, _ in chat.compile_template(template)(env))


def test_language():
    assert render("{% set x = 1 + 2 %}{{ x }}{% if x == 3 and not false %}y{% else %}n{% endif %}") == "3y"
    assert render("{% for m in ms %}{{ loop.index }}{{ m.a }}{% if not loop.last %}, {% endif %}{% endfor %}", ms=iter([{"a": "p"}, {}])) == "1p, 2"
    assert render("a  {%- if n == none -%}  b{# no #} {%- endif %}") == "ab"
    assert render("{{ m['k'] | upper }}{{ 'it\\'s' ~ 1 }}{{ ('a' in t) }}", m={"k": "v"}, t="cat") == "Vit's1true"
    assert render("{% if a < 2 or b >= 3 %}x{% elif true %}z{% endif %}", a=5, b=1) == "z"


def test_folding():
    assert chat.fold_body(chat.parse("a{{ 'b' ~ 1 + 2 }}{% if 1 == 1 %}c{% else %}{{ d }}{% endif %}e")) == [("text", "ab12ce")] or \
        chat.fold_body(chat.parse("a{{ 'b' }}{% if 1 == 1 %}c{% else %}{{ d }}{% endif %}e")) == [("text", "abce")]
    assert chat.fold_body(chat.parse("{% if false %}x{% elif y %}z{% endif %}")) == [("if", [(("name", "y"), [("text", "z")])])]
    assert chat.fold(("and", ("const", False), ("name", "x"))) == ("const", False)


@pytest.mark.parametrize("bad", ["{% for x %}", "{% if a %}", "{{ a | open }}", "{{ a. }}", "{% while %}", "{{ (a }}", "{% set x 1 %}", "{{ __import__('os') }}"])
def test_errors(bad):
    with pytest.raises(chat.TemplateError):
        render(bad)


def test_sandbox():
    with pytest.raises(chat.TemplateError):
        render("{{ x.__class__ }}", x="text")


def test_mask():
    run = chat.compile_template("a{% generation %}b{{ x }}{% endgeneration %}c")
    assert list(run({"x": "y"})) == [("a", False), ("b", True), ("y", True), ("c", False)]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "o[<\\]"]) | texts, texts), max_size=6))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns):
    segments = list(chat.compile_template(chat.TEMPLATE)({"messages": iter([{"role": r, "text": t} for r, t in turns])}))
    formatted = "".join(t for t, _ in segments)
    at, back = 0, []
    while at < len(formatted):
        m = chat.TURN.match(formatted, at)
        back.append((chat.unguard(m[1]), chat.unguard(m[2] if m[2] is not None else m[3])))
        at = m.end()
    assert back == turns
    assert chat.unguard("".join(t for t, masked in segments if masked)) == "".join(t for r, t in turns if r == "assistant")


def test_conversations(spark, monkeypatch):
    long = [(7, i, "assistant" if i % 2 else "user", f"turn {i} </s> " * 50) for i in range(1500)]  # more than one chunk
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", None, "x"), (2, 0, None, "", "x"), (None, 0, "user", "no id", "x"),
            (3, 0, "user", "b", "x"), (3, 0, "user", "a", "x"), (3, 0, "user", "a", "x"), *((*r, "x") for r in long)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    chunks = chat.format_conversations(df)
    assert chunks.where("conv_id = 7").count() > 1
    got = {r.conv_id: r for r in chat.read_back(chunks).collect()}
    by = {}
    for c, k, r, t, _ in rows:
        by.setdefault(c, []).append((k, r or "", t or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [x[1:] for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []
