"""Main text by votes, whatever the tags; no part of an article goes."""

from __future__ import annotations

from emberline.llm import html_text

LONG = "A paragraph of the main text that goes on for quite a while and says one thing and then another. " * 4
LINKS = "<div><a>One</a> <a>Two</a> <a>Three</a></div>"


def paragraphs(*words):
    return "".join(f"<p>{w} {LONG}</p>" for w in words)


def test_teasers_in_article_elements_do_not_win():
    teaser = "<article><h3>Other</h3><p>Read <a>more</a> of it.</p></article>"
    page = f"<body><div><div>{paragraphs('first', 'second', 'third')}</div>{teaser}{teaser}</div></body>"
    got = html_text.main_text(page)
    assert all(w in got for w in ("first", "second", "third"))


def test_page_without_tags_of_an_article():
    page = f"<body>{LINKS}<div><h1>Head</h1>{paragraphs('first')}<p>Ok.</p>{paragraphs('second')}</div>{LINKS}</body>"
    got = html_text.main_text(page)
    assert got.startswith("Head first") and "Ok." in got and "second" in got and "Three" not in got


def test_an_article_in_siblings_is_whole():
    for tag in ("section", "div", "article"):
        page = f"<body>{LINKS}<div><{tag}>{paragraphs('first', 'second')}</{tag}><{tag}>{paragraphs('third')}</{tag}></div>{LINKS}</body>"
        got = html_text.main_text(page)
        assert all(w in got for w in ("first", "second", "third")) and "Three" not in got
    cells = f"<body><table><tr><td>{paragraphs('first')}</td><td>{paragraphs('second')}</td></tr></table></body>"
    assert "first" in html_text.main_text(cells) and "second" in html_text.main_text(cells)


def test_part_of_a_name_does_not_remove_the_article():
    for name in ("content with-sidebar", "post share-enabled", "reader-view"):
        page = f'<body>{LINKS}<div class="{name}">{paragraphs("first", "second")}<div class="share-buttons"><p>Share this</p></div></div>{LINKS}</body>'
        got = html_text.main_text(page)
        assert "first" in got and "second" in got and "Share this" not in got


def test_captions_stay():
    page = f"<article>{paragraphs('first')}<figure><img src='x'><figcaption>The caption.</figcaption></figure>{paragraphs('second')}</article>"
    assert "The caption." in html_text.main_text(page)


MENU = '<div id="menu"><a>One</a> <a>Two</a></div>'
FOUR = paragraphs("first", "second", "third", "fourth")


def whole(page):
    got = html_text.main_text(page)
    assert all(f"{w} {LONG.strip()}" in got for w in ("first", "second", "third", "fourth"))
    assert "One" not in got and "Two" not in got
    return got


def test_form_around_a_page():
    whole(f"<body><form action='x'>{MENU}<div>{FOUR}</div></form></body>")
    got = whole(f"<body>{MENU}<div>{FOUR}<form>Your name <input> <button>Send</button></form></div></body>")
    assert "Your name" not in got


def test_names_that_stand_for_other_things():
    whole(f'<body>{MENU}<div id="reader">{FOUR}</div></body>')
    whole(f'<body>{MENU}<article class="post widget">{FOUR}</article></body>')
    got = whole(f'<body>{MENU}<div>{FOUR}<div class="widget">Weather today</div><p class="notice">We moved.</p></div></body>')
    assert "Weather today" not in got and "We moved" not in got


def test_parts_of_names_below_blocks():
    page = (f'<body>{MENU}<div><h1 class="banner-title">The title</h1><p class="no-ads">first {LONG}</p><p>second {LONG}</p>'
            f'<p>An <span class="alert-text">urgent</span> word.</p>{paragraphs("third", "fourth")}</div></body>')
    got = whole(page)
    assert got.startswith("The title first") and "An urgent word." in got


def test_menu_that_is_not_closed():
    for tag in ("div", "main", "article", "section"):
        whole(f"<body><nav><a>One</a> <a>Two</a><{tag}>{FOUR}</{tag}></body>")
    whole(f"<body><aside><a>One</a> <a>Two</a><main>{FOUR}</main></body>")


def test_comments_that_outweigh_the_article_go():
    for name in ("comments", "comment", "replies"):
        page = f'<body>{MENU}<article>{FOUR}</article><div class="{name}">{"<p>Mine " + LONG * 3 + "</p>"}{"<p>Mine " + LONG * 9 + "</p>"}</div></body>'
        assert "Mine" not in whole(page)


def by_hand(html):
    """Container, ratio, smoothing, threshold and choice over a page of divs and paragraphs only, with plain loops."""
    import math
    import re
    lines, path, tags, nodes = [], [0], 0, {0: None}
    for close, tag, text in re.findall(r"<(/?)(\w+)>|([^<]+)", html):
        if text:
            lines.append([text.strip(), tags, path[-1]])
            tags = 0
        elif tag == "div" and not close:
            tags += 1
            nodes[len(nodes)] = path[-1]
            path.append(len(nodes) - 1)
        else:
            # The tag that ends a line is met after it.
            tags += 1
            if close and tag == "div":
                path.pop()
    ratio = [len(t) / max(n, 1) for t, n, _ in lines]
    weight = {k: math.exp(-k * k / 2) for k in range(-2, 3)}
    smooth = [sum(weight[k] * ratio[min(max(i + k, 0), len(ratio) - 1)] for k in weight) / sum(weight.values()) for i in range(len(ratio))]
    at = sum(smooth) / len(smooth)
    for _ in range(50):
        low, high = [x for x in smooth if x < at], [x for x in smooth if x >= at]
        if not low:
            break
        at = (sum(low) / len(low) + sum(high) / len(high)) / 2
    low, high = [x for x in smooth if x < at], [x for x in smooth if x >= at]
    if not low or sum(low) / len(low) > 0.5 * sum(high) / len(high):
        at = min(smooth)

    def inside(own, node):
        while own is not None and own != node:
            own = nodes[own]
        return own == node
    votes = {n: sum(len(t) for (t, _, own), x in zip(lines, smooth, strict=True) if x >= at - 1e-9 and inside(own, n)) for n in nodes}
    full = {n: sum(len(t) for t, _, own in lines if inside(own, n)) for n in nodes}
    best = max(n for n in nodes if votes[n] >= 0.9 * votes[0])
    up = best
    while (up := nodes[up]):
        if full[up] <= 1.3 * full[best]:
            best = up
    return " ".join(t for t, _, own in lines if inside(own, best))


def test_against_plain_loops():
    import random
    for seed in range(300):
        draw = random.Random(seed)

        def some(depth, draw=draw):
            out = ""
            for _ in range(draw.randrange(1, 5)):
                if depth < 3 and draw.random() < 0.4:
                    out += f"<div>{some(depth + 1)}</div>"
                else:
                    out += f"<p>{'w' * draw.choice([3, 9, 40, 200, 400])}</p>"
            return out
        page = some(0)
        assert html_text.main_text(page) == by_hand(page), seed
