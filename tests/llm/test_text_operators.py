"""PII, mixing, chat, URL rules, HTML and quality rules against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymill.llm import chat, html_text, mixing, pii, quality_rules, queries, url_rules
from quaymill.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

EDGES = [
    None,
    "",
    " \t\n\u000b\u000c\r ",
    "mail a.b@c-d.example.com_x@y.org, z@w or a@b@c.de.",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255 12.3.4",
    "4111 1111-1111 1111 and 4111111111111112 5500-0000-0000-0004 7",
    "+1 (555) 010-9999, +49-30-1234567890123, +12 3",
    "ümlaut é 4111\u00011111 1111 1111 a\u0001b@c.d call 555-123-4567 IBAN DE89 3704 0044 0532 0130 00",
    "9 " * 30_000,
    "1.2.3.4 " * 3_000,
    "a." * 20_000 + "@b" + ".c" * 20_000,
    "x" * 200_000,
]


def _luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        digit = int(char)
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def _base_spans(text: str) -> list[tuple[int, int, int]]:
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m.split("."))) <= 255),
        (
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 14 <= len(d := re.sub(r"\D", "", m)) <= 19 and _luhn(d),
        ),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
    ]
    return sorted(
        (m.start(), number, m.end())
        for number, (pattern, valid) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if valid(m[0])
    )


def _expected_pii(text: str | None) -> tuple:
    spans = _base_spans(text or "")
    told = ",".join(f"{pii.BASE[n]}:{start}:{end}" for start, n, end in spans)
    counts = Counter(n for _, n, _ in spans)
    return (*(counts[n] for n in range(4)), hashlib.sha256(told.encode()).hexdigest())


@pytest.fixture(scope="module")
def real_docs(spark):
    return [tuple(row) for row in table(spark, SF_DIR, "documents").select(*[c.split()[0] for c in DOCS.split(", ")]).collect()]


def test_pii_equals_plain_patterns(spark, real_docs):
    # The plain pattern needs a square of steps on a run of x, so that text is not in this list.
    texts = [row[1] for row in real_docs] + EDGES[:-1]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {row["doc_id"]: row for row in pii.pii_digest(frame, ["doc_id"]).collect()}
    for number, text in enumerate(texts):
        row = got[number]
        assert tuple(row)[1:6] == _expected_pii(text), (number, (text or "")[:80])
    spans = got[len(real_docs) + 7]["spans"].split(",")
    assert {span.split(":")[0] for span in spans} >= {"local_phone", "iban"}


def test_pii_of_a_long_run_ends(spark):
    frame = spark.createDataFrame([(1, EDGES[-1])], "doc_id long, text string")
    assert pii.pii_digest(frame, ["doc_id"]).first()["spans"] == ""


def test_redaction_takes_effect_and_keeps_columns(spark):
    rows = [(1, "é me@x.org 1.2.3.4", "en", "s", 18), (2, None, None, None, None), (2, "clean", "en", "s", 5)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("pii", F.lit("mine"))
    got = {tuple(row) for row in pii.redact_pii(frame).collect()}
    assert got == {
        (1, "é [EMAIL] [IP]", "en", "s", 14, "mine"),
        (2, None, None, None, None, "mine"),
        (2, "clean", "en", "s", 5, "mine"),
    }


# --- mixing ---------------------------------------------------------------------------------


def _expected_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {source: 1 + place % 3 for place, source in enumerate(order)}
    left, pool, out = set(sizes), sum(sizes.values()), {}
    while left:
        total = sum(weights[s] for s in left)
        over = [s for s in left if pool * weights[s] > 3 * sizes[s] * total]
        if not over:
            return out | {s: pool * weights[s] / total for s in left}
        for source in over:
            out[source] = 3.0 * sizes[source]
            pool -= 3 * sizes[source]
            left.discard(source)
    return out


@pytest.mark.parametrize("case", ["real", "edges"])
def test_mix_meets_its_targets(spark, real_docs, case):
    rows = real_docs
    if case == "edges":
        rows = [(n, "w " * (n % 9), "en", ["b", None, "a", "é", "Z"][min(n % 37, 4)], n) for n in range(900)]
        rows += [(None, None, None, None, None), (3, "", "en", "only empty", 0), rows[50], rows[50]]
        rows += [(5000, "long " * 20_000, "en", "tiny", 1)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("mine"))
    keep = ["doc_id", "text", "source", "size"]
    got = mixing.mix(frame.repartition(7), keep=keep).collect()
    again = mixing.mix(frame.repartition(3), keep=keep).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert Counter(tuple(row)[:4] for row in got) == Counter((r[0], r[1], r[3], "mine") for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for row in got:
        assert row["size_"] == len(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or ""))
        sizes[row["source"]] += row["size_"]
        taken[row["source"]] += row["taken"]
        assert 0 <= row["taken"] <= 3 * row["size_"]
    targets = _expected_targets(sizes)
    for row in got:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.5


def test_mixed_rows_hold_the_words_taken(spark, real_docs):
    frame = spark.createDataFrame(real_docs, DOCS)
    want = {(r["doc_id"], r["taken"]) for r in mixing.mix(frame).collect() if r["taken"]}
    rows = mixing.mixed_rows(frame).collect()
    sums = defaultdict(int)
    for row in rows:
        assert row["words"] == len(re.findall(r"[^\x20\x09-\x0D]+", row["text"]))
        sums[row["doc_id"]] += row["words"]
    assert set(sums.items()) == want


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    empty = spark.createDataFrame([(1, None, "en", None, 0)], DOCS)
    assert [(r["target"], r["taken"]) for r in mixing.mix(empty).collect()] == [(0.0, 0)]


# --- chat -----------------------------------------------------------------------------------


def test_chat_reads_back_what_went_in(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [
        (-1, 1, "assistant", "first \\ <turn>x<says>y</turn> \\\\"),
        (-1, None, "user", None),
        (-1, 0, None, "</turn"),
        (-1, 2, "assistant", "</turn><\\/turn>\n\n"),
        (-2, 0, "user", "no reply"),
        (-3, 0, "assistant", "same"),
        (-3, 0, "assistant", "same"),
        (None, 0, "role<says>", "é" * 5000),
        (-7, 0, "user", "\\### Assistant: </turn> ok"),
        (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {row["conv_id"]: row for row in chat.chat_digest(chat.format_chats(frame)).collect()}
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        turns[conv_id].append((turn is None, turn or 0, role or "", text or ""))
    assert set(got) == set(turns)
    for conv_id, told in turns.items():
        told.sort()
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in told)
        loss = "".join(text for _, _, role, text in told if role == "assistant")
        row = got[conv_id]
        assert row["n_turns"] == len(told)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_chars"] == len(loss)
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(frame.limit(0)).collect() == []


def test_examples_hold_only_earlier_turns(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(frame).orderBy("example").collect()
    assert [r["formatted"].count("<turn>") for r in got] == [2, 4, 5]
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in got] == ["a1", "a2", ""]


# --- urls -----------------------------------------------------------------------------------


def _expected_url(url: str | None, rules: list) -> tuple:
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule_host, rule_path, verdict in rules:
        fits = host == rule_host or host.endswith("." + rule_host)
        if fits and path.startswith(rule_path):
            key = (len(rule_host) + len(rule_path), len(rule_host), verdict)
            best = max(best or key + ("",), key + (rule_host + rule_path,))
    return (host, path, best and best[3], best[2] if best else "allow")


def test_url_rules_equal_a_search_of_all_rules(spark):
    rules = queries.URL_RULES + [
        ("a.example.org", "/", "block"), ("a.example.org", "/es", "allow"), ("a.example.org", "", "allow"),
        ("b.org", "/x/y", "block"), ("org", "/x/yyyyy", "allow"), ("dup.com", "/", "allow"), ("dup.com", "/", "block"),
        ("", "", "block"),
    ]
    hosts = ["example.org", "A.Example.ORG", "x.a.example.org", "xexample.org", "b.org", "c.b.org", "org", "dup.com", "fr.com", "", "org.", "é.com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/fr/", "/fr/#/de/", "/x/yyyyy", "/x/y", "?a=/es/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme/es/", "a://b://c/d", "http://"]
    frame = spark.createDataFrame([(n, u, "mine") for n, u in enumerate(urls)], "page_id long, url string, rule string")
    known = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")
    for block in (200_000, 3):
        got = url_rules.judge_urls(frame.repartition(3), known, rules_per_block=block).collect()
        assert len(got) == len(urls)
        for row in got:
            assert tuple(row)[1:3] == (urls[row["page_id"]], "mine")
            assert tuple(row)[3:] == _expected_url(row["url"], rules), row
    assert url_rules.judge_urls(frame.limit(0), known).collect() == []
    assert {r["verdict"] for r in url_rules.judge_urls(frame, known.limit(0)).collect()} == {"allow"}


# --- html and quality rules -----------------------------------------------------------------


def test_html_text(spark):
    article = "<article><h1>T &amp; U</h1><p>one\n <b>two<br>three</b></p><ul><li>item</ul><p>x&nbsp;y</article>"
    furniture = (
        "<nav><a>menu</a></nav><div class='ad'>buy " + "now " * 90 + "</div>",
        "<footer>&copy; me</footer><section id=comments>" + "<p>great post indeed</p>" * 30 + "</section>",
    )
    page = f"<html><head><title>no</title></head><body>{furniture[0]}{article}<script>var t='</p>';</script>{furniture[1]}"
    loose = "<body><div class=header>site</div><div>" + "words " * 40 + "</div><p>short</p><form>" + "f " * 90 + "</form>"
    rows = [(1, page), (2, loose), (3, None), (4, ""), (5, "<p unclosed"), (6, "<article></article>"), (1, page)]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("mine"))
    got = html_text.extract_text(frame).collect()
    by_id = {row["page_id"]: row["text"] for row in got}
    assert len(got) == 7 and got[0].asDict().keys() == {"page_id", "html", "text", "n_chars"}
    assert by_id[1] == "T & U\n\none two three\n\nitem\n\nx y"
    assert by_id[2] == ("words " * 40).strip() + "\n\nshort"
    assert [by_id[n] for n in (3, 4, 5, 6)] == [""] * 4
    assert all(row["n_chars"] == len(row["text"]) for row in got)


def test_repeats_equal_a_comparison_of_all_suffixes():
    random = np.random.default_rng(5)
    texts = [random.integers(0, 2, random.integers(0, 30)) for _ in range(80)] + [np.zeros(33, int)]
    words = np.concatenate(texts).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want = []
    for t in texts:
        for i in range(len(t)):
            most = 0
            for j in set(range(len(t))) - {i}:
                k = 0
                while max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                    k += 1
                most = max(most, k)
            want.append(most)
    assert quality_rules.longest_repeats(words, text).tolist() == want


def _expected_counts(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, copies, len(inside), failed)


def test_quality_counts(spark, real_docs):
    texts = [row[1] for row in real_docs] + [None, "", " \n\t", "a\n a\na\n\n", "é\u0085x \u00a0 y", "w " * 5000]
    frame = spark.createDataFrame([(n, t, n) for n, t in enumerate(texts)], "doc_id long, text string, other long")
    got = quality_rules.judge_quality(frame.repartition(3)).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row)[3:8] + (row["base_failed"],) == _expected_counts(row["text"])
        assert not (row["base_failed"] and row["kept"])
