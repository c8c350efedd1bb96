"""Templates compiled to columns: what they print, and what they refuse."""

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import pipelines, prompts
from corpusloom.plans.provider import StubProvider
from corpusloom.plans.templates import Library, TemplateError, library


@pytest.fixture(scope="module")
def rows(spark):
    schema = "t string, n int, x double, ok boolean, xs array<string>, odd string"
    return spark.createDataFrame([("a", 5, 1.5, True, ["p", None, "q"], "%}"), ("", 0, 0.0, False, [], "{{ t }}"), (None, None, None, None, None, None)], schema)


def say(rows, text, texts=None, **given):
    files = Library({"m": text} | (texts or {}))
    return [r.prompt for r in files.render(rows, "m", **given).select("prompt").collect()]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", ["", "", ""]),
        ("fixed\n", ["fixed"] * 3),
        ("fixed\n\n", ["fixed\n"] * 3),
        ("<{{ t }}|{{n}}|{{ x }}|{{ ok }}>", ["<a|5|1.5|true>", "<|0|0.0|false>", "<|||>"]),
        ("{{ odd }}", ["%}", "{{ t }}", ""]),
        ("{{ n - 1 }},{{ n -1 }},{{ n * 2 + 1 }},{{ n % 3 }},{{ n // 2 }},{{ -n }}", ["4,4,11,2,2,-5", "-1,-1,1,0,0,0", ",,,,,"]),
        ("{{ 'r' + t + n }}", ["ra5", "r0", "r"]),
        ("{% if t %}T{% elif n == 0 %}zero{% else %}none{% endif %}!", ["T!", "zero!", "none!"]),
        ("{% if xs %}{{ xs | join(', ') }}{% endif %}{{ xs|length }}", ["p, q3", "0", ""]),
        ("{% if n %}1{% endif %}{% if ok %}2{% endif %}{% if x %}3{% endif %}{% if not t %}4{% endif %}", ["123", "4", "4"]),
        ("{% if t and n > 4 %}A{% endif %}{% if t or n == 0 %}O{% endif %}{% if 0 < n <= 5 %}C{% endif %}", ["AOC", "O", ""]),
        ("{{ 'y' if ok else 'n' }}{{ t | default('-') }}{{ t | default('b') | upper }}", ["yaA", "n", "n-B"]),
        ("{{ ' s ' | trim }}{{ 'AB' | lower }}", ["sab"] * 3),
        ("a {#- note {{ t }} -#} b", ["ab"] * 3),
        ("a \n {%- if ok -%} \n b \n {%- else -%} c {%- endif -%} \n d", ["abd", "acd", "acd"]),
        ("x\n{{- t -}}\ny", ["xay", "xy", "xy"]),
        ("{% if n %}\n{% if t %}in{% endif %}\n{% endif %}", ["\nin\n", "", ""]),
        ("it's \"quoted\" \\n $1 {0} { }", ["it's \"quoted\" \\n $1 {0} { }"] * 3),
        ("{{ 'a\\nb' }}", ["a\nb"] * 3),
    ],
)
def test_rendered(rows, text, want):
    assert say(rows, text) == want


def test_inheritance_and_includes(rows):
    texts = {
        "base": "[{% block a %}base a{% endblock %}|{% block b %}base b{% endblock b %}|{% include 'part' %}]",
        "mid": "{% extends 'base' %}ignored{% block a %}mid({{ super() }}){% endblock %}",
        "part": "{% if t %}{{ t }}{% endif %}",
    }
    assert say(rows, "{% extends 'mid' %}{% block a %}top({{ super() }}){% endblock %}{% block b %}{{ n }}{% endblock %}", texts)[0] == "[top(mid(base a))|5|a]"
    assert say(rows, "{% extends 'base' %}", texts)[1] == "[base a|base b|]"
    # A block inside a block, and one that comes only in a parent's block
    texts["base"] = "{% block out %}<{% block a %}1{% endblock %}>{% endblock %}"
    assert say(rows, "{% extends 'base' %}{% block a %}2{% endblock %}", texts)[0] == "<2>"
    assert say(rows, "{% include 'part' %}-{% include 'part' %}", texts)[0] == "a-a"


@pytest.mark.parametrize(
    ("text", "why"),
    [
        ("{{ nobody }}", "nothing is given for 'nobody'"),
        ("{% if t %}{{ nobody }}{% endif %}", "nobody"),
        ("{% extends 'm' %}", "m extends m"),
        ("{% extends 'b' %}", "m extends b extends m"),
        ("{% include 'i' %}", "m includes i includes m"),
        ("{% extends 'missing' %}", "no template"),
        ("{% if t %}x", "without an end"),
        ("{% endif %}", "without if"),
        ("{% block a %}{% endif %}", "without if"),
        ("{% block a %}{% endblock b %}", "ends block a"),
        ("{% block a %}{% endblock %}{% block a %}{% endblock %}", "name of its own"),
        ("{% if t %}{% else %}{% elif n %}{% endif %}", "after else"),
        ("{% for x in xs %}{% endfor %}", "unknown tag"),
        ("{{ t", "half a tag"),
        ("t }}", "half a tag"),
        ("{{ t %}", "half a tag"),
        ("{{ xs }}", "by way of join"),
        ("{{ t | join }}", "takes a list"),
        ("{{ t | shout }}", "unknown filter"),
        ("{{ n + 1 | length }}", "don't know"),
        ("{{ t.upper() }}", "don't know"),
        ("{{ __import__('os') }}", "don't know"),
        ("{{ n - }}", "no expression"),
        ("{{ super() }}", "don't know"),
        ("{% block a %}{{ super() }}{% endblock %}", "nothing above"),
        ("{% extends t %}", "in quotes"),
    ],
)
def test_refused_while_compiling(rows, text, why):
    with pytest.raises(TemplateError, match=why.replace("(", r"\(").replace(")", r"\)")):
        say(rows, text, {"b": "{% extends 'm' %}", "i": "{% include 'm' %}"})


def test_given_values_and_names(spark, rows):
    files = Library({"m": "{{ a }}{{ b }}{{ c }}{% if d %}{{ t }}{% endif %}", "sub": "{% extends 'm' %}"})
    assert files.names("sub") == {"a", "b", "c", "d", "t"}
    got = files.render(rows, "m", "t", a=F.col("n") + 1, b="x", c=None, d=True)  # the text takes the place of a column
    assert [r.t for r in got.collect()] == ["6xa", "1x", "x"] and got.columns == rows.columns


def test_templates_stay_in_generated_code(spark):
    """One projection, no Python, and columns that aren't asked for aren't read."""
    df = spark.range(10).selectExpr("id", "cast(id as string) t", "id n", "'unused' u")
    plan = Library({"m": "{% if n %}{{ t }}{% else %}0{% endif %}"}).render(df, "m").select("prompt")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "unused" not in plan


def test_library_of_any_path(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("{% extends 'b.txt' %}\n")
    (tmp_path / "sub" / "b.txt").write_text("line 1\n{{ t }}\n")
    files = Library.of_path(spark, str(tmp_path))
    assert files.texts == {"a.txt": "{% extends 'b.txt' %}\n", "b.txt": "line 1\n{{ t }}\n"}
    (tmp_path / "b.txt").write_text("again")
    with pytest.raises(TemplateError, match="one name"):
        Library.of_path(spark, str(tmp_path))


def test_every_template_of_the_package_compiles():
    files = library()
    assert len(files.texts) >= 19 and all(files.names(name) is not None for name in files.texts)
    assert files.names("system_mcqa_step2.txt") == {"role", "task", "level", "n_options", "example"}
    assert files.names("user_mcqa_step2.txt") == {"n_datasets", "title", "contents", "table", "prev_example"}


def test_a_run_with_templates_of_its_own(spark):
    """Calls carry what the run's own files say."""
    said = []

    class Listening(StubProvider):
        def complete(self, task):
            answer = super().complete(task)
            return answer | {"hallucination_desc": task["system"] + "/" + task["user"]} if task["eval_type"] == "hallucination" else answer

    texts = dict(library().texts) | {"system_hallucination.txt": "JUDGE", "user_hallucination.txt": "{{ options | length }} options"}
    refs = spark.createDataFrame([(f"r_{i}", "t", "c") for i in range(3)], "index string, title string, contents string")
    got = pipelines.mcqa(refs, pipelines.Settings(n_datasets=1, max_step=1, templates=Library(texts)), Listening())
    said = {r.hallucination_desc for r in got.collect()}
    assert said and all(x.startswith("JUDGE/") and x.endswith(" options") for x in said)


def test_a_step_without_examples_has_no_prompt(spark):
    row = spark.createDataFrame([("t", "c", None)], "title string, contents string, prev_example string")
    assert row.select(prompts.user_prompt_for("mcqa", 2)).first()[0] is None
