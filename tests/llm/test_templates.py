import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.llm import templates as tp


def brute(texts):
    """The rule as the module states it, line by line."""
    token = re.compile(r"[^\x20\x09-\x0D]+")
    mask = lambda t: "<*>" if re.search("[0-9]", t) else t
    lines = [(i, line) for i, text in enumerate(texts) for line in (text or "").split("\n")]
    masked = {line: [mask(t) for t in token.findall(line)] for _, line in lines if token.search(line)}
    leaf_of = {line: (len(found), *found[:3]) for line, found in masked.items()}
    times = Counter(line for _, line in lines)
    leaves = Counter(leaf_of[line] for _, line in lines if line in leaf_of)
    seen = Counter()
    for _, line in lines:
        if line in leaf_of:
            seen.update((leaf_of[line], k, t) for k, t in enumerate(masked[line]) if t != "<*>")
    templates = defaultdict(set)
    for line, leaf in leaf_of.items():
        level = {
            k: (leaves[leaf] // seen[leaf, k, t]).bit_length() if leaves[leaf] >= seen[leaf, k, t] else 1
            for k, t in enumerate(masked[line])
            if t != "<*>" and seen[leaf, k, t] >= 10
        }
        for at in set(level.values()):
            shown = [t if level.get(k, 99) <= at else "<*>" for k, t in enumerate(masked[line])]
            if sum(level.get(k, 99) <= at for k in range(len(shown))) >= len(shown) / 2:
                templates[line].add((leaf, " ".join(shown)))
        if times[line] >= 10 and leaves[leaf] >= 10:
            templates[line].add((leaf, "=" + line))
    holders = defaultdict(set)
    for i, line in lines:
        for template in templates[line]:
            holders[template].add(i)
    gone = {line for line, own in templates.items() if any(len(holders[t]) >= 10 for t in own)}
    return [
        (len((t or "").split("\n")), sum(x in gone for x in (t or "").split("\n")),
         "\n".join(x for x in (t or "").split("\n") if x not in gone))
        for t in texts
    ]


def texts():
    rng = random.Random(3)
    word = lambda: rng.choice("alpha beta gamma delta straße omega".split()) + rng.choice(["", "s", "ed"])
    result = [None, "", "\n\n", "a b", "one two three 4"] + ["same line of five\nsame line of five"] * 3
    for i in range(60):
        body = [" ".join(word() for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            body.insert(rng.randint(0, len(body)), f"user {word()} logged in at {rng.randint(0, 99)}:{i}")
        if i % 4 == 0:
            body.append(f"user {word()}{i} logged in  at 7 ")
        if i % 7 == 0:
            body += [f"count is now {i}", f"count is now {i + 1}"]
        result.append("\n".join(body))
    result += ["total rows were 5 today"] * 12
    for i in range(40):  # short lines, lines of digits, values that are frequent, and rare ones
        result.append(
            "\n".join(
                ["Read more"] * (i % 3) + [f"(c) 2023 {i % 2} 1-800"] + [f"page {i}"] * (i % 2)
                + [f"Written by name{'abc'[i % 3]} from city{'xyzw'[i % 4]}", f"seen by {word()} only once"]
            )
        )
    return result


def test_against_plain_python(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string").repartition(3)
    kept, (n_lines, n_dropped) = tp.drop_templates(docs)
    assert kept.columns == [*docs.columns, n_lines, n_dropped]
    got = {r.doc_id: (r[n_lines], r[n_dropped], r.text or "") for r in kept.collect()}
    want = brute(texts())
    assert [got[i] for i in range(len(want))] == want
    assert sum(w[1] for w in want) > 20


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    plan = tp.drop_templates(docs)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tp.drop_templates(none)[0].count() == 0
    same = spark.createDataFrame([(None, "the same four words")] * 11, "doc_id long, text string")
    kept, (_, n_dropped) = tp.drop_templates(same)
    assert kept.agg(F.sum(n_dropped)).first()[0] == 11


def test_frequent_values_stay_variable_when_the_input_grows(spark):
    pairs = [(f"name{a}", f"city{b}") for a in "abcdef" for b in "abcdef"]
    lines = [f"Article was written by {name} from {city}" for name, city in pairs]
    for copies in (1, 2, 5):
        docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines * copies)], "doc_id long, text string")
        kept, (_, n_dropped) = tp.drop_templates(docs)
        assert kept.agg(F.sum(n_dropped)).first()[0] == len(lines) * copies
    # A document that repeats its own line does not shield it.
    alone = ["\n".join(["Article was written by someone from somewhere"] * 10)] + lines[:12]
    docs = spark.createDataFrame(list(enumerate(alone)), "doc_id long, text string")
    kept, (_, n_dropped) = tp.drop_templates(docs)
    assert kept.where("doc_id = 0").first()[n_dropped] == 10


def test_short_and_digit_lines_that_recur_are_dropped(spark):
    gone = ["All rights reserved", "Read more", "Imprint", "(c) 2023-2024 Acme 1-800-555-0100 24/7", "12 34"]
    rows = [(i, "\n".join([*gone, "", f"{chr(97 + i)} own", f"{i} {i} {i} {i}"])) for i in range(12)]
    docs = spark.createDataFrame(rows + [(99, "Rare line")], "doc_id long, text string")
    kept, (_, n_dropped) = tp.drop_templates(docs)
    got = {r.doc_id: (r[n_dropped], r.text) for r in kept.collect()}
    assert got == {i: (5, f"\n{chr(97 + i)} own\n{i} {i} {i} {i}") for i in range(12)} | {99: (0, "Rare line")}


def test_many_recurring_lines_in_one_text(spark):
    """Linear in the lines of a text."""
    import time

    long = "\n".join(["All rights reserved", "a line of its own"] * 100_000)
    docs = spark.createDataFrame([(i, "All rights reserved") for i in range(12)] + [(99, long)], "doc_id long, text string")
    began = time.monotonic()
    kept, (_, n_dropped) = tp.drop_templates(docs)
    row = kept.where("doc_id = 99").first()
    assert row[n_dropped] == 100_000 and row.text == "\n".join(["a line of its own"] * 100_000)
    assert time.monotonic() - began < 60
