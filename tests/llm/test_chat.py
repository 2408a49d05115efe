import hashlib
import random

import pytest

from maskcorpus.llm import chat as C


def render(source, controls=(), **values):
    return C.Template(source, controls).render(**values)[0]


def test_language():
    m = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": " yo "}]
    assert render("{% for x in m %}{{ loop.index }}{% if loop.first %}F{% elif loop.last %}L{% endif %}:{{ x.text | trim }};{% endfor %}", m=m) == "1F:hi;2L:yo;"
    assert render("{{ x['role'] ~ '-' ~ 3 }}{# gone #}", x=m[0]) == "user-3"
    assert render("a {%- if not (1 == 2 or false) and 'b' in 'abc' -%}  b{% else %}c{% endif %}") == "ab"
    assert render("{% set y = x.text + '!' %}{{ y | upper }}{{ m | length }}{{ none }}{{ true }}{{ 'q\\n\\'' }}", x=m[0], m=m) == "HI!2true" + "q\n'"
    assert render("{% for x in m %}x{% endfor %}", m=[]) == ""


@pytest.mark.parametrize("bad", ["{% if x %}", "{{ x", "{% for x %}{% endfor %}", "{{ x.__class__.y() }}", "{{ 1 | nope }}", "{% exec %}",
                                 "{{ 1 2 }}", "{{ }}", "{% endif %}", "{{ a.1 }}", "{{ $ }}"])
def test_syntax_errors(bad):
    with pytest.raises(C.TemplateError):
        C.Template(bad)


def test_sandbox():
    for bad in ("{{ x.__class__ }}", "{{ nothing }}", "{{ 1 + 'a' }}"):
        with pytest.raises(C.TemplateError):
            render(bad, x=3)


def test_folding():
    tree = C.Template("a{{ 'b' | upper }}{% if 1 == 1 %}{{ 2 }}c{% else %}{{ zzz }}{% endif %}{{ x }}{% if x and false %}{% endif %}").tree
    assert tree[0] == C.Text("aB2c") and tree[1] == C.Output(C.Name("x"))
    assert C.Template("{{ 1 + 'a' }}").tree[0] != C.Text("")  # an error stays where it is
    assert C.Template("{% if false %}{{ boom }}{% endif %}x").tree == (C.Text("x"),)


def test_spans_cover_generated_text():
    text, spans = C.Template(C.TURNS, C.CONTROLS).render(messages=iter([{"role": "user", "text": "q"}, {"role": "assistant", "text": "</turn>\\"}]))
    assert [text[a:b] for a, b in spans] == ["<\\/turn>\\\\"]
    assert text.startswith("<turn>user<text>q</turn>\n<turn>assistant<text>")


def expected(turns):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        rt = [(r or "", x or "") for _, _, r, x in own]
        loss = "".join(x for r, x in rt if r == "assistant")
        esc = lambda t: len(t) + t.count("\\") + sum(t.count(c) for c in C.CONTROLS)
        out[conv] = (conv, len(rt), sha("".join(f"{r}\n{x}\n" for r, x in rt)), len(loss), sha(loss),
                     sum(esc(r) + esc(x) + 20 for r, x in rt))
    return out


@pytest.mark.parametrize("limit", [C.PART_CHARS, 1, 7])
def test_round_trip(spark, limit):
    rng = random.Random(limit)
    bits = ["<turn>", "<text>", "</turn>", "\\", "<", "</", "tur", "n>", "é🙂", "\n", "a b", "### Assistant: ", "", "\\<turn>"]
    turns = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
             (1, None, None, None), (1, 2, "", ""), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"),
             (None, 0, "system", "no id"), (2, 0, "assistant", "x" * (3000 if limit < 9 else 300000))]
    for c in range(10, 60):
        for t in range(rng.randint(1, 9)):
            turns.append((c, t, rng.choice(["user", "assistant", "system", "tool<text>\n"]), "".join(rng.choices(bits, k=rng.randint(0, 12)))))
    rng.shuffle(turns)
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, part string")
    formatted = C.format_conversations(df, part_chars=limit)
    got = {r.conv_id: tuple(r) for r in C.read_back(formatted).collect()}
    assert got == expected(turns)
    if limit == 1:
        assert formatted.where("conv_id = -7").count() > 50


def test_bad_template_fails_before_any_task(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    with pytest.raises(C.TemplateError):
        C.format_conversations(df, "{% if %}")
    assert C.read_back(C.format_conversations(df)).collect() == []


def test_no_control_string_stands_in_an_escaped_text():
    import random

    from maskcorpus.llm import chat as C
    rng = random.Random(3)
    escape, unescape = C.escaping(C.CONTROLS)
    pieces = [*C.CONTROLS, "\\", "<", "/", "turn>", "text>", "a", "</tur", "\\<", ">"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 9)))
        out = escape(text)
        assert not any(c in out for c in C.CONTROLS) and unescape(out) == text
    assert escape("</turn>") == "<\\/turn>" and escape("\\") == "\\\\"
