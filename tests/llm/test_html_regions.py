"""The ratios decide which regions of a page are its text."""

import numpy as np

from reviewmill.llm import html_text

WORDS = "a sentence of the body that goes on for quite a while and says something"
BODY = [f"{k} {WORDS} {k}" for k in range(12)]
LINKS = "".join(f"<div><a href=/{k}><b><i>item {k}</i></b></a></div>" for k in range(60))


def body(tag=""):
    inside = "".join(f"<p>{x}</p>" for x in BODY)
    return f"<{tag}>{inside}</{tag}>" if tag else inside


def test_text_outside_of_a_marked_teaser():
    page = f"<body><article><h2>Read also</h2></article><div>{LINKS}</div>{body('section')}</body>"
    got = html_text.main_text(page).split("\n")
    # Smoothing may take a line next to the text along.
    assert got[-len(BODY) :] == BODY and len(got) <= len(BODY) + 2 and "Read also" not in got


def test_an_article_is_taken_whole_where_it_holds_the_text():
    page = f"<body><div>{LINKS}</div><article><h1>Title</h1>{body()}<p>End.</p></article></body>"
    assert html_text.main_text(page) == "\n".join(["Title", *BODY, "End."])


def test_without_ratios_the_result_differs():
    page = f"<body><div>{LINKS}</div><article><h1>Title</h1>{body()}</article></body>"
    flat = html_text.main_text(page, rate=lambda lines: np.ones(len(lines)))
    assert html_text.main_text(page) == "\n".join(["Title", *BODY]) and "item 5" in flat


def test_a_short_article_between_long_ones_stays():
    other = "".join(f"<p>other {x}</p>" for x in BODY)
    page = f"<article>{body()}</article><article><p>teaser</p></article><article>{other}</article>"
    assert html_text.main_text(page).split("\n") == [*BODY, "teaser", *(f"other {x}" for x in BODY)]
