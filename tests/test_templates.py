"""Templates against what a plain renderer makes of them."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import templates as T

RECORD = "id int, name string, dose double, tags array<string>, parts array<struct<k: string, v: int>>, meta struct<a: string, b: struct<c: int>>"
ROWS = [
    (1, "  Ann ", 2.5, ["x", "y"], [("p", 1), ("q", None)], ("first", (7,))),
    (2, None, None, [], None, (None, None)),
    (3, "", 0.0, ["z"], [("r", 3)], ("third", (None,))),
]


def shown(spark, template, **names):
    df = spark.createDataFrame(ROWS, RECORD)
    return [r[0] for r in df.sort("id").select(T.rendered(template, names)).collect()]


@pytest.mark.parametrize(
    "template, want",
    [
        ("plain text, no tag\n\n", ["plain text, no tag\n"] * 3),
        ("- {{ name }}", ["-   Ann\n", "- None\n", "-\n"]),
        ("- a: {{ meta.a if meta.a is not none else \"not specified\" }}.", ["- a: first.\n", "- a: not specified.\n", "- a: third.\n"]),
        ("{{ (\"%.2f%%\"|format(dose)) if dose is not none else 'none at all' }}", ["2.50%\n", "none at all\n", "0.00%\n"]),
        ("<{{ meta.b.c }}>{# a remark #}<{{ meta['a'] }}>", ["<7><first>\n", "<None><None>\n", "<None><third>\n"]),
        ("A\n{% if dose > 1 %}\nhigh\n{% elif dose is none %}\nunknown\n{% else %}\nlow\n{% endif %}\nZ", ["A\nhigh\nZ\n", "A\nunknown\nZ\n", "A\nlow\nZ\n"]),
        ("{% for t in tags %}[{{ t|upper }}]{% endfor %}!", ["[X][Y]!\n", "!\n", "[Z]!\n"]),
        ("{% for p in parts %}\n- {{ p.k }}={{ p.v if p.v is not none else '?' }}\n{% endfor %}\nend", ["- p=1\n- q=?\nend\n", "end\n", "- r=3\nend\n"]),
        ("{{ tags|join(', ') }}|{{ tags|length }}", ["x, y|2\n", "|0\n", "z|1\n"]),
        ("{{ name|default('nobody')|trim|lower }}.", ["ann.\n", "nobody.\n", ".\n"]),
        ("{% if name %}named{% else %}nameless{% endif %}", ["named\n", "nameless\n", "nameless\n"]),
        ("{% if name is none or not dose %}odd{% endif %}", ["\n", "odd\n", "odd\n"]),
        ("{{ id + 1 }} {{ 'none of it' }}", ["2 none of it\n", "3 none of it\n", "4 none of it\n"]),
        ("{% for p in parts %}{% if p.v is none %}-{% else %}{{ p.v }}{% endif %}{% endfor %}{{ missing }}", ["1-m\n", "m\n", "3m\n"]),
    ],
)
def test_rendered(spark, template, want):
    assert shown(spark, template, missing=F.lit("m")) == want


def test_decimals_as_python_writes_them(spark):
    import random

    from tessera.functions import expressions as E

    draw = random.Random(4)
    values = [2.675, 2.5, 0.125, 0.375, 1.005, -1.005, -0.001, 0.0, 1e14, 123456789.125, 1e18, float("nan"), float("inf"), float("-inf"), 0.5, 1.5, 1e-300]
    values += [round(draw.uniform(-300, 300), d) for d in range(6) for _ in range(200)] + [k / 8 for k in range(-40, 40)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").sort("k")
    for digits in (0, 1, 2, 3):
        got = [r[0] for r in df.select(E.fixed(F.col("v"), digits)).collect()]
        assert got == [f"%.{digits}f" % v for v in values]
    assert shown(spark, "{{ 'a%% %s %d %.1f|'|format(name, id, dose) if dose is not none else '-' }}") == ["a%   Ann  1 2.5|\n", "-\n", "a%  3 0.0|\n"]


@pytest.mark.parametrize("template", ["{{ '%x'|format(id) }}", "{{ '%d'|format(id, id) }}", "{{ '%d %d'|format(id) }}", "{{ a b }}", "{{ name|unknown }}", "{% if name %}x", "{% endif %}", "{% while x %}", "{{ [1] }}", "{% for t in tags %}x", "{{ dose in tags }}"])
def test_unknown_tags_fail_when_the_template_is_read(spark, template):
    with pytest.raises(T.TemplateError):
        T.rendered(template)


def test_rendering_runs_no_python(spark):
    df = spark.createDataFrame(ROWS, RECORD).select(T.rendered("{% for t in tags %}{{ t }}{% endfor %}{{ ('%.1f'|format(dose)) if dose is not none else '-' }}"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
