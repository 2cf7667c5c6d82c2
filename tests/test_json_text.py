import json

from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import is_json, is_json_object, line_kind, line_problem, strip_space

TRICKY = [
    '{"a":1}', '{"a":1} x', '{"a":1}} x', '{"a":1}] x', '{"a":1},{"b":2}', '1,"x":2', "123",
    '"x"', "null", "[1]", "", "   ", '{"a":1,"a":2}', "{'a':1}", '{"a":', '{"a":01}',
    '{"a":"\\q"}', '{"a":1}{"b":2}', '[{"a":1},{"a":2}]', '{"a":"t\tt"}', '{"a":1,}', "[]",
    "],[", '{"a":tru}', ' {"a":1} ', '{"a":1}\t', '{"a":1} //c', '{"a":NaN}', "NaN",
    '{"a":1},{"__end__":1}', '[1],[{"__end__":1}]', ' {"a":1} ', "{}", "[[]]",
    '{"a":"\\ud83d\\ude00"}', '{"é":"ü"}', '[{"a":1}] ]', '{"a":1}]},{"r":[', '"a","b"', "-0",
    "1.5e3", "+1", ".5", "tru", "{", "}", "[", "]", '"', "\\", '{"a" 1}', '{1:2}', '[1 2]',
]


def python_accepts(text: str) -> bool:
    try:
        json.loads(text.strip())
    except ValueError:
        return False
    return True


def judge(spark, lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    text = strip_space(F.col("value"))
    found = df.select(
        "i",
        is_json(text).alias("json"),
        is_json_object(text).alias("object"),
        line_problem(text).alias("problem"),
        line_kind(F.col("value")).alias("kind"),
        text.alias("text"),
    )
    return {r["i"]: r for r in found.collect()}


def test_validity_agrees_with_python(spark):
    found = judge(spark, TRICKY)
    for i, line in enumerate(TRICKY):
        assert found[i]["text"] == line.strip(), line
        assert found[i]["json"] == python_accepts(line), line


def test_object_check_agrees_with_python(spark):
    found = judge(spark, TRICKY)
    for i, line in enumerate(TRICKY):
        want = python_accepts(line) and isinstance(json.loads(line.strip()), dict)
        assert found[i]["object"] == want, line


def test_problem_is_null_exactly_for_record_lines(spark):
    found = judge(spark, TRICKY)
    for i, line in enumerate(TRICKY):
        if not line.strip():
            want = "blank"
        elif not python_accepts(line):
            want = "invalid_json"
        else:
            value = json.loads(line.strip())
            many = isinstance(value, list) and all(isinstance(v, dict) for v in value)
            want = None if isinstance(value, dict) or many else "not_object"
        assert found[i]["problem"] == want, line


def test_generated_documents_and_their_damaged_forms(spark):
    scalars = st.one_of(
        st.none(), st.booleans(), st.integers(-(10**12), 10**12), st.text(max_size=8)
    )
    values = st.recursive(
        scalars,
        lambda inner: st.one_of(
            st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=4), inner, max_size=3)
        ),
        max_leaves=6,
    )
    import random

    from hypothesis import HealthCheck, given, settings

    lines = []

    @settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
    @given(values, st.integers(0, 1 << 30))
    def gather(value, seed):
        text = json.dumps(value)
        rng = random.Random(seed)
        at = rng.randrange(len(text) + 1)
        lines.append(text)
        lines.append(text[:at])
        lines.append(text[:at] + rng.choice('{}[],:"x1 ') + text[at:])
        lines.append(text + rng.choice(['}', ']', ' x', ',{"b":1}', ',1', '"']))

    gather()
    found = judge(spark, lines)
    wrong = [line for i, line in enumerate(lines) if found[i]["json"] != python_accepts(line)]
    assert not wrong, wrong[:5]


def test_line_kind(spark):
    found = judge(spark, ["  {x", "\t[", "", " \n", "abc", " {"])
    assert [found[i]["kind"] for i in range(6)] == [
        "object", "array", "blank", "blank", "other", "object",
    ]
