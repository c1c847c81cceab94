"""Cases of the text operators that need the whole of a text, page or benchmark."""

from __future__ import annotations

import pyarrow as pa

from quaymill.llm import decontaminate, html_text, pii, toxicity


def test_wrappers_and_unclosed_paragraphs_keep_the_article():
    body = "<p>" + "The text of the page goes on for a while. " * 5 + "</p>"
    for label in ("content with-sidebar", "no-sidebar", "menu-open", "has-banner", "sidebar"):
        page = f"<body><div class='{label}'><article><header class='entry-header'><h1>Title</h1></header>{body}</article></div></body>"
        assert html_text.main_text(page).startswith("Title\n\nThe text"), label
    page = f"<article><p class='notice'>Seen by few<p>First part {body}<ul><li class='ad'>Buy<li>Second part</ul></article>"
    text = html_text.main_text(page)
    assert "First part" in text and "Second part" in text and "Seen" not in text and "Buy" not in text
    page = f"<div class='site-footer'>{body}</div><div class='cookie-banner'>{body}</div>"
    assert html_text.main_text(page) == ""


def test_context_reaches_past_the_previous_match(spark):
    texts = ["SSN: 123-45-6789, 219-09-9999", "call 555-123-4567 or 555-987-6543"]
    far = "call 555-123-4567 " + "x " * 30 + "555-987-6543"
    docs = spark.createDataFrame([(text,) for text in [*texts, far]], "text string")
    got = [row["text"] for row in pii.redact_pii(docs, n_chars=None).collect()]
    assert got[:2] == ["SSN: [SSN], [SSN]", "call [LOCAL_PHONE] or [LOCAL_PHONE]"]
    assert got[2].endswith("555-987-6543")


def test_screen_drops_no_text_with_features():
    grammar = toxicity.Grammar({"idiota": 2.0, "moron": 2.0}, {"stup": 1.5})
    texts = ["¡Idiota!", "‘moron’", "you—moron", "«stupido»", "a moron", "，moron，", "kind words", "señor", None]
    features = [any(grammar.features(text or "")) for text in texts]
    assert features == [True] * 6 + [False] * 3
    assert grammar.suspects(pa.array(texts)).tolist() == features


def test_similarity_does_not_depend_on_item_blocks(spark):
    words = [f"w{n}" for n in range(400)]
    shared = words[:12]
    items = [(n, " ".join(shared + words[20 + 20 * n : 36 + 20 * n])) for n in range(12)]
    docs = [(n, text + " tail of the text") for n, text in items]
    docs += [(50 + n, " ".join(f"z{k}" if k in (2, 3) else w for k, w in enumerate(text.split()))) for n, text in items]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def leaks(limit: int) -> dict:
        rows = decontaminate.find_leaks(docs, bench, items_per_block=limit).collect()
        return {(row["doc_id"], row["item_id"]): round(row["similarity"], 9) for row in rows}

    whole = leaks(100)
    assert len(whole) >= 24 and min(whole.values()) < 1
    assert leaks(3) == whole
