"""The composed toxicity grammar against single machines, and line blocks on pages of all kinds."""

from __future__ import annotations

import random
import time

import pytest

from quaymill.llm import html_text
from quaymill.llm.toxicity import AIM, CLASSES, MATCHES, NEGATION, REPORT, TABLE, Grammar
from quaymill.llm.transducers import best_path

GRAMMAR = Grammar({"idiot": 2.0, "moron": 2.0, "kill": 1.5}, {"stup": 1.5})


def naive_best(symbols: list[str], amounts: list[float], starts: list[str]) -> float | None:
    """The greatest score over every path of the three machines, one after the other, nothing composed."""
    scores = []

    def walk(at: int, states: list[str], score: float) -> None:
        if at == len(symbols):
            scores.append(score)
            return

        def feed(level: int, symbol: str, following: list[str], weight: float) -> None:
            if level == 3:
                walk(at + 1, following, score + weight * amounts[at])
                return
            for write, state, more in (REPORT, NEGATION, AIM)[level].arcs[states[level], symbol]:
                feed(level + 1, write, [*following, state], weight + more)

        feed(0, symbols[at], [], 0.0)

    walk(0, starts, 0.0)
    return max(scores, default=None)


def test_the_composed_table_finds_the_best_path_of_the_single_machines():
    draw = random.Random(3)
    found = 0
    for _ in range(400):
        symbols = [draw.choice(CLASSES) for _ in range(draw.randrange(7))] + ["stop"]
        amounts = [draw.choice((0.5, 1.0, 2.0)) if symbol in MATCHES else 0.0 for symbol in symbols]
        written, _ = best_path(TABLE, TABLE.start, symbols, amounts)
        worth = {"threat": 3.0, "aimed": 2.0, "plain": 1.0, "denied": 1.0, "reported": 1.0}
        want = naive_best(symbols, amounts, [REPORT.start, NEGATION.start, AIM.start])
        assert sum(worth[kind] * amount for kind, amount in written) == pytest.approx(want)
        found += bool(written)
    assert found > 100


@pytest.mark.parametrize(
    "text, kinds",
    [
        ('He said: "You idiot. You moron."', ["reported", "reported"]),
        ("You are never ever in my life an idiot", ["denied"]),
        ("I like you and he is an idiot", ["plain"]),
        ("What an idiot you are", ["aimed"]),
        ("You are a stupid moron, idiot", ["aimed"]),
        ("I will burn you. I will burn it.", ["threat"]),
        ("You should burn!", ["threat"]),
        ('An "open quote, idiot\n\nyou idiot', ["reported", "aimed"]),
        ("You are kind", []),
        ("", []),
    ],
)
def test_sentences(text, kinds):
    found = [[kind for kind, amount in sums.items() if amount] for sums in GRAMMAR.clauses(text)]
    assert found == [[kind] for kind in kinds]


PARAGRAPH = "<p>" + "The story goes on with more words. " * 6 + "</p>"
LINKS = "<ul>" + "".join(f"<li><a href='/{n}'>Entry number {n}</a></li>" for n in range(20)) + "</ul>"


@pytest.mark.parametrize("box", ["article", "main", "div"])
def test_runs_of_links_dive_with_and_without_an_article(box):
    story = f"<h1>Head</h1>{PARAGRAPH}<p>short</p>"
    text = html_text.main_text(f"<body>{LINKS}<{box}>{story}{LINKS}{PARAGRAPH}<p><a>one</a> end</p></{box}>{LINKS}</body>")
    parts = text.split("\n\n")
    assert parts[0] == "Head" and parts[2] == "short" and parts[-1] == "one end" and len(parts) == 5
    assert "Entry" not in text
    assert html_text.main_text(f"<{box}>{LINKS}</{box}>") == ""


def test_unclosed_links_and_quotes_lose_no_text():
    assert html_text.main_text(f"<article><p><a href=x>Top</p>{PARAGRAPH * 3}</article>").count("story") == 18
    assert html_text.main_text('<article><p title="a > b">One</p><p class=">Two</p>').endswith("Two")
    assert html_text.main_text("<article>1 < 2 <b>and</b> 3<!-- no --> > 2<p>x<script>y</script>z</article>") == "1 < 2 and 3 > 2\n\nx z"


@pytest.mark.parametrize(
    "name", "ad-slot ad-unit google-ads comment-body user-comments related-articles cookie-law share-tools".split()
)
def test_composed_class_names(name):
    assert "Extra" not in html_text.main_text(f"<article>{PARAGRAPH}<div class='{name}'>Extra</div></article>")


@pytest.mark.parametrize(
    "broken",
    ['<a "' * 400_000, '<a href="' * 150_000 + ">", "<!x" * 500_000, "<!--" * 400_000, "<script" * 200_000, "<" * 1_000_000],
    ids=["quotes", "values", "declarations", "comments", "scripts", "signs"],
)
def test_broken_markup_takes_linear_time(broken):
    start = time.process_time()
    html_text.main_text(broken)
    assert time.process_time() - start < 2


def test_deep_nesting_takes_linear_time():
    start = time.process_time()
    html_text.main_text("<ul><li><div>" * 50_000 + "<li></p></td>" * 50_000)
    assert time.process_time() - start < 5
