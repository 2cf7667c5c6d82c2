import random
import re
import time

from millrace.llm import quotes as q

A = "The first message says a lot.\n\nIt has two paragraphs\nand three lines."
B = "I disagree with the second point."
C = "So do I, and that for good reasons."


def rows():
    return [
        (1, 0, "user", A),
        (1, 1, "assistant", "Nothing is quoted in this one here."),
        (1, 2, "user", "On Monday X wrote:\n> It has two  paragraphs and\n> three lines.\n\n" + B),
        (1, 3, "user", "> The FIRST message says a lot.\nThanks for that, really."),
        (1, 4, "assistant", f">> It has two paragraphs\n>> and three lines.\n> {B}\n{C}"),
        (2, 0, "user", f"Y wrote:\n\n> {C}\n\nThis came to another list."),
        (2, 1, "user", "> This came to another list.\n> ok\nFine with me, all of it."),
        (3, 0, "user", "> nobody has written this line anywhere\nAlone here for ever."),
        (3, 1, "user", None),
        (3, 2, "user", ""),
        (3, 2, "user", ""),
        (None, 5, "user", f"> {B}\nNo conversation at all."),
        (4, None, "user", f"> {B}\nNo turn at all."),
        (5, 0, "user", "> Alone here for ever.\n> > Fine with me, all of it.\n\n\n\nLast words."),
    ]


def test_links_order_and_texts(spark):
    frame = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string").repartition(4)
    got = q.reply_ordered(frame).collect()
    assert len(got) == len(rows())
    parents = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn, r.level) for r in got}
    assert parents[1, 2] == (1, 0, 1) and parents[1, 3] == (1, 0, 1) and parents[1, 4] == (1, 2, 2)
    assert parents[2, 0] == (1, 4, 3) and parents[2, 1] == (2, 0, 4) and parents[3, 0] == (None, None, 0)
    assert parents[5, 0] == (3, 0, 1)
    assert parents[None, 5] == (None, None, 0) and parents[4, None] == (None, None, 0)
    first = sorted((r.position, r.conv_id, r.turn) for r in got if r.conversation == 1)
    assert first == [(0, 1, 0), (1, 1, 2), (2, 1, 3), (3, 1, 4), (4, 2, 0), (5, 2, 1), (6, 1, 1)]
    texts = {(r.conv_id, r.turn): r.text for r in got}
    assert texts[1, 2] == B and texts[1, 4] == C and texts[1, 0] == A
    assert texts[2, 0] == "This came to another list." and texts[5, 0] == "Last words." and texts[3, 1] == ""
    third = sorted(r.position for r in got if r.conversation == 3)
    assert third == list(range(5))


def test_long_chain(spark):
    said = [f"message number {i} in a long chain" for i in range(40)]
    chain = [(1, i, "user", (f"> {said[i - 1]}\n" if i else "") + said[i]) for i in range(40)]
    got = q.reply_ordered(spark.createDataFrame(chain, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.position, r.turn, r.level) for r in got) == [(i, i, i) for i in range(40)]


def test_levels():
    assert q.levels("a\n>b\n> > c\n >> d\n>") == [(0, "a"), (1, "b"), (2, "c"), (2, "d"), (1, "")]


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert q.reply_ordered(none).count() == 0


def plain(text):
    return " ".join(text.lower().split())


def brute(messages):
    """(conv_id, turn) of the message each one replies to, by comparing its quotations with every earlier message."""
    parsed = {}
    for conv, turn, _, text in messages:
        lines = [(len(re.findall(">", m)), rest) for m, rest in (re.match(r"((?:[ \t]*>)*) ?(.*)", x).groups() for x in text.split("\n"))]
        found, held = {}, []
        for i, (level, line) in enumerate([*lines, (-1, "")]):
            if held and (level != lines[i - 1][0] or not line.strip()):
                found.setdefault((lines[i - 1][0], plain(" ".join(held))), 1)
                held = []
            if line.strip():
                held.append(line)
                found.setdefault((level, plain(line)), 1)
        parsed[conv, turn] = [(level, p) for level, p in found if len(p) >= q.MIN_CHARS]
    parents = {}
    for me, quoted in parsed.items():
        votes = {}
        for level, passage in quoted:
            if level < 1:
                continue
            holders = [key for key, own in parsed.items() if (0, passage) in own]
            same = min((k for k in holders if k[0] == me[0]), default=None)
            first = min(holders, default=None)
            if same and same[1] < me[1]:
                origin = same
            elif first and first[0] != me[0] and first < me:
                origin = first
            else:
                continue
            votes[level, origin] = votes.get((level, origin), 0) + len(passage)
        best = min(((level, -n, origin) for (level, origin), n in votes.items()), default=None)
        parents[me] = best[2] if best else (None, None)
    return parents


def test_random_threads_against_brute_force(spark):
    rng = random.Random(5)
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    say = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(2, 7))) + f" {rng.randint(0, 400)}"
    messages = []
    for conv in range(12):
        for turn in range(rng.randint(1, 9)):
            lines = [say() for _ in range(rng.randint(1, 4))]
            for _ in range(rng.randint(0, 2)):
                if messages and rng.random() < 0.7:
                    other = rng.choice(messages[-12:] if rng.random() < 0.8 else messages)[3].split("\n")
                    at = rng.randrange(len(other))
                    mark = rng.choice(["> ", ">", " > ", "> > "])
                    some = [mark + x.upper() if rng.random() < 0.2 else mark + x for x in other[at : at + rng.randint(1, 3)]]
                    lines[rng.randint(0, len(lines)) : 0] = [rng.choice(["Z wrote:", ""]), *some, ""]
            messages.append((conv, turn, "user", "\n".join(lines)))
    frame = spark.createDataFrame([(*m, "x", 1) for m in messages], "conv_id long, turn long, role string, text string, level string, id int")
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in q.reply_ordered(frame.repartition(5)).collect()}
    want = brute(messages)
    assert got == want and sum(p[0] is not None for p in want.values()) > 20


def test_long_texts_are_read_in_proportion_to_their_lines(spark):
    text = "\n".join(["> a quoted line that stands here", "an answer to it that is given", "Q wrote:", ""] * 50_000)
    began = time.monotonic()
    found = q.without_quotes(q.levels(text))
    assert found.count("an answer") == 50_000 and found.count("wrote") == 1 and time.monotonic() - began < 20
    rows = [(1, 0, "user", "a quoted line that stands here"), (1, 1, "user", text)]
    got = q.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.turn, r.parent_turn, r.level) for r in sorted(got, key=lambda r: r.turn)] == [(0, None, 0), (1, 0, 1)]
