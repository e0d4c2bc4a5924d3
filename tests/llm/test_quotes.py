import random
import re

import pytest
import regex

from slotwise.llm import quotes
from slotwise.llm.quotes import format_chat, link_quotes
from tests.conftest import SF_SMALL

ROW = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "Hello there friend.\nHow is the weather in Paris?\n\nSecond paragraph here"),
    (1, 1, "assistant", "> How is the weather   in PARIS?\nSunny and warm today"),
    (1, 2, "user", "On Mon, A wrote:\n> Hello there friend.\n> How is the weather in Paris?\nAnother answer to first"),
    (1, 3, "user", ">> How is the weather in Paris?\n> Sunny and warm today\nGood to know"),
    (1, 4, "assistant", "> Sunny and warm today\n> > of a quote\nyes"),
    (1, 5, "user", "unrelated > not quote"),
    (1, 6, "user", "> never said before\nhm"),
    (1, 7, "user", "> Good to know\nok ok"),
    (1, 8, "user", ">>> How is the weather in Paris?\n> not found anywhere\ndeep"),
]


def cut_lines(text):
    """(has quotes, (level, body) per line)."""
    out = []
    for line in re.split(r"\r?\n", text):
        m = re.match(quotes.MARK, line)
        out.append((m.group(1).count(">"), line[m.end():]) if m else (0, line))
    return bool(re.search(r"(?m)^[ \t]*>", text)), out


def normal(text):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip(" ")


def pieces(text):
    parts = [text, *re.split(r"\n\s*\n", text), *text.split("\n"), *re.split(r"[.!?]+(?=\s|$)|[。！？]+", text)]
    found = [normal(p) for p in parts]
    return list(dict.fromkeys(u for i, u in enumerate(found) if len(u) >= quotes.MIN_CHARS or i == 0 and u))


def brute(rows):
    """(conv, turn): (parent, path, n_quotes, n_linked, content), of rows without nulls."""
    parsed = []
    for conv, turn, _, text in rows:
        has, lines = cut_lines(text)
        passages, own = [], []
        for k, (level, body) in enumerate(lines):
            if passages and passages[-1][0] == level:
                passages[-1][1].append(body)
            else:
                passages.append((level, [body]))
            announces = re.match(quotes.ANNOUNCES, body) and k + 1 < len(lines) and lines[k + 1][0] > 0
            if level == 0 and not announces:
                own.append(body)
        said = re.sub(r"\n{3,}", "\n\n", re.sub(r"^\s+|\s+$", "", "\n".join(own))) if has else text
        parsed.append((conv, turn, said, [(v, "\n".join(b)) for v, b in passages if v > 0] if has else []))
    parents = {}
    for conv, turn, _, passages in parsed:
        links, rest = [], set()
        for level, passage in passages:
            for unit in pieces(passage):
                source = min((t for c, t, own, _ in parsed if c == conv and unit in pieces(own)), default=turn)
                if source < turn:
                    links.append((level, len(unit), source))
                elif len(unit.split(" ")) >= quotes.RUN_WORDS:
                    rest.add((level, unit))
        for level, unit in rest:
            held = [t for c, t, own, _ in parsed if c == conv and t < turn and f" {unit} " in f" {normal(own)} "]
            links += [(level, len(unit), min(held))] if held else []
        if links:
            by = {s: (min(v for v, _, x in links if x == s), sum(n for _, n, x in links if x == s)) for _, _, s in links}
            parents[conv, turn] = max(by, key=lambda s: (-by[s][0], by[s][1], s)), len(links)
    out = {}
    for conv, turn, own, passages in parsed:
        path = [turn]
        while (conv, path[0]) in parents:
            path.insert(0, parents[conv, path[0]][0])
        parent, n = parents.get((conv, turn), (None, 0))
        out[conv, turn] = (parent, path, len(passages), n, own)
    return out


def thread(rng, conv, turns=14):
    """A random thread: nested quotes, wrapped elsewhere, parts, ties and repeated messages."""
    words = "the river old mill rained noon bridge closed police walked along road yes no maybe why städte 雨".split()
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 9))).capitalize() + rng.choice([".", "!", "?", ""])
    said, rows = [], []
    for turn in range(turns):
        body = rng.choice(["\n", "\n\n", " "]).join(sentence() for _ in range(rng.randint(1, 4)))
        if said and rng.random() < 0.15:
            body = rng.choice(said)
        text = body
        for _ in range(rng.randint(0, 2) if said else 0):
            flat = rng.choice(said).split(" ")
            a = rng.randint(0, max(0, len(flat) - 5))
            part = flat if rng.random() < 0.5 else flat[a:a + rng.randint(1, 9)]
            width = rng.randint(2, 8)
            lines = rng.choice(said).split("\n") if rng.random() < 0.4 else [" ".join(part[k:k + width]) for k in range(0, len(part), width)]
            mark = rng.choice(["> ", ">> ", "> > ", ">", " > "])
            text = rng.choice(["", "On Monday A wrote:\n"]) + "\n".join(mark + x.replace("\n", " ") for x in lines) + "\n" + text
        said.append(body)
        rows.append((conv, turn, rng.choice("ab"), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_threads_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [r for conv in range(12) for r in thread(rng, conv)]
    want = brute(rows)
    got = {(r.conv_id, r.turn): (r.parent_turn, r.reply_path, r.n_quotes, r.n_linked, r.content)
           for r in link_quotes(spark.createDataFrame(rows, ROW).repartition(3)).collect()}
    assert got == want and sum(p is not None for p, *_ in want.values()) > 40


def test_a_phrase_that_many_say_and_quote(spark):
    """One conversation: each distinct quoted text is looked up once, however many quote it."""
    rows = [(1, t, "a", f"we saw the old mill by the river again number {t}") for t in range(150)]
    rows += [(1, 200 + t, "b", "> saw the old mill by the river\nI see") for t in range(150)]
    got = {r.turn: r.parent_turn for r in link_quotes(spark.createDataFrame(rows, ROW)).collect()}
    assert all(got[200 + t] == 0 and got[t] is None for t in range(150))


def test_links_paths_and_contents(spark):
    got = [(r.turn, r.parent_turn, r.reply_path, r.content) for r in format_chat(link_quotes(spark.createDataFrame(ROWS, ROW))).collect()]
    assert got == [
        (0, None, [0], ROWS[0][3]),
        (1, 0, [0, 1], "Sunny and warm today"),
        (3, 1, [0, 1, 3], "Good to know"),
        (7, 3, [0, 1, 3, 7], "ok ok"),
        (4, 1, [0, 1, 4], "yes"),
        (2, 0, [0, 2], "Another answer to first"),
        (8, 0, [0, 8], "deep"),
        (5, None, [5], "unrelated > not quote"),
        (6, None, [6], "hm"),
    ]


def test_long_chain(spark):
    rows = [(1, i, "user", (f"> message number {i - 1} of all\n" if i else "") + f"message number {i} of all") for i in range(70)]
    got = {r.turn: r.reply_path for r in link_quotes(spark.createDataFrame(rows, ROW)).collect()}
    assert got == {i: list(range(i + 1)) for i in range(70)}


def test_the_earliest_speaker_of_a_line_is_linked(spark):
    rows = [(1, t, "user", "the same old line") for t in range(5)] + [(1, 5, "user", "> the same old line\nx"), (2, 1, "user", "> the same old line\ny")]
    got = {(r.conv_id, r.turn): r.parent_turn for r in link_quotes(spark.createDataFrame(rows, ROW)).collect()}
    assert got[1, 5] == 0 and got[2, 1] is None


def test_parts_of_lines_other_breaks_and_short_messages(spark):
    said = "We met at noon. The bridge was closed by the police, so everyone walked along the river to the old mill. Then it rained."
    rows = [(1, 0, "a", "Something about the old mill and the river"), (1, 1, "b", said), (1, 2, "c", "Yes."),
            (1, 3, "d", "> Then it rained.\nreally"),
            (1, 4, "e", "> by the police, so everyone\n> walked along the river to\n> the old\nwhich police"),
            (1, 5, "f", "> Yes.\nwhy"),
            (1, 6, "g", "> the police walked along the road\nno"),
            (2, 0, "a", "好"), (2, 1, "b", "昨天下雨了。今天天气非常好我们去公园。明天再说"), (2, 2, "c", "> 今天天气非常好我们去公园\n去"), (2, 3, "d", "> 好\n对"),
            (3, 0, "a", "Yes. I think so"), (3, 1, "b", "> Yes.\nwhy")]
    got = {(r.conv_id, r.turn): r.parent_turn for r in link_quotes(spark.createDataFrame(rows, ROW)).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {(1, 3): 1, (1, 4): 1, (1, 5): 2, (2, 2): 1, (2, 3): 0}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, "user", "> Hello there friend."), (None, 1, "x", "> abc def ghi"), (1, 1, None, "> short"),
            (2, 0, "a", "some long line"), (2, 0, "a", "some long line"), (2, 1, "b", ">some long line"), (2, 1, "b", ">some long line"),
            (3, 0, "a", "word " * 20000 + "\n" + "> q\n" * 50)]
    df = spark.createDataFrame([(*r, "z") for r in rows], ROW + ", content string")
    got = link_quotes(df).collect()
    assert len(got) == len(rows) and sum(r.parent_turn == 0 for r in got) == 2
    assert link_quotes(df.limit(0)).count() == 0


def test_conversations_without_quotes_stay(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = format_chat(link_quotes(df)).collect()
    want = df.orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.turn, r.role, r.content) for r in got] == [(r.conv_id, r.turn, r.role, r.text) for r in want]
    plan = link_quotes(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
