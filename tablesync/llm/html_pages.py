"""Labelled training pages for the block labeller, made from layout templates.

Each page is a list of (html, main) parts in page order: ``main`` says whether
the text of the part belongs to the article.  Words are invented; the layouts
cover semantic tags, class and id names, bare ``div`` pages, adverts inside the
article, and reader comments after it.
"""

from __future__ import annotations

import random

SYLLABLES = ("an", "ter", "on", "the", "re", "in", "la", "ver", "ent", "mi", "co", "sta", "ge", "al", "du", "é", "ü", "ço")
NAV = ('<nav><ul>{li}</ul></nav>', '<div class="menu"><ul>{li}</ul></div>', '<div id="navbar">{a}</div>',
       '<header><div class="logo">{short}</div><nav>{a}</nav></header>', '<ul class="nav navigation">{li}</ul>',
       '<div class="breadcrumbs">{a}</div>', '<div role="navigation">{a}</div>', '<div class="topbar">{a}</div>')
HEADER = ('<header><p>{text}</p></header>', '<div class="header">{short}</div>', '<div id="masthead"><span>{text}</span></div>',
          '<header class="site-header"><h2>{short}</h2><p>{text}</p></header>', '<div class="banner">{text}</div>')
FOOTER = ('<footer>&copy; {short} &middot; {text}</footer>', '<div class="footer"><p>{text}</p>{a}</div>',
          '<div id="footer"><ul>{li}</ul><p>{short}</p></div>', '<footer><p>{text}</p><p>{text}</p></footer>',
          '<div class="copyright">&copy; {short}</div>', '<div role="contentinfo"><p>{text}</p></div>')
SIDE = ('<aside><h3>{short}</h3><ul>{li}</ul></aside>', '<div class="sidebar"><p>{text}</p><p>{text}</p></div>',
        '<div id="sidebar"><h4>{short}</h4>{a}</div>', '<aside><p>{text}</p></aside>',
        '<div class="related"><h3>{short}</h3><ul>{li}</ul></div>', '<div class="widget"><p>{text}</p></div>',
        '<section class="recommended"><p>{text}</p>{a}</section>', '<div class="tags share">{a}</div>')
NOTICE = ('<div class="cookie-notice"><p>{text}</p></div>', '<div class="notice">{text}</div>', '<div id="cookie-banner">{text}</div>',
          '<div class="alert" role="alert"><p>{text}</p></div>', '<div class="popup modal"><p>{text}</p></div>',
          '<div class="consent gdpr"><p>{text}</p><button>{short}</button></div>', '<dialog><p>{text}</p></dialog>',
          '<div class="newsletter subscribe"><p>{text}</p></div>')
ADVERT = ('<div class="ad">{text}</div>', '<div class="advert"><p>{text}</p></div>', '<div id="ads">{text}</div>',
          '<div class="sponsored"><p>{text}</p></div>', '<aside class="ad"><p>{text}</p></aside>', '<div class="promo">{text}</div>',
          '<ins class="adsbygoogle">{text}</ins>', '<div class="advertisement banner"><span>{text}</span></div>')
FORM = ('<form><label>{short}</label><input type="text"><button>{short}</button></form>',
        '<form class="search"><p>{text}</p><input></form>', '<form><select><option>{short}</option></select></form>',
        '<div class="login"><form><p>{short}</p></form></div>', '<form><fieldset><legend>{short}</legend><p>{text}</p></fieldset></form>')
COMMENT = ('<section class="comments"><h2>{short}</h2><div class="comment"><p>{text}</p></div><div class="comment"><p>{text}</p></div></section>',
           '<div id="comments"><p>{text}</p><p>{text}</p></div>', '<ol class="commentlist"><li>{text}</li><li>{text}</li></ol>',
           '<div class="reader-comments"><article><p>{text}</p></article></div>', '<div class="discussion replies"><p>{text}</p></div>',
           '<ul class="comment-list"><li><span class="author">{short}</span><p>{text}</p></li></ul>', '<div class="user-comment">{text}</div>')
OPEN = ('<article>', '<main>', '<div class="content">', '<div id="content">', '<div class="post"><div class="entry-content">',
        '<main><article>', '<div class="article-body">', '<div class="story">', '<section class="main">', '<div>', '',
        '<div id="main"><div class="text">', '<div class="container"><article>')
CLOSE = ('</article>', '</main>', '</div>', '</div>', '</div></div>', '</article></main>', '</div>', '</div>', '</section>',
         '</div>', '', '</div></div>', '</article></div>')
BODY = ('<p>{text}</p>', '<p>{text}</p>', '<p>{text} {text}</p>', '<p><b>{text}<br>', '<p>{short}</p>', '<h2>{short}</h2>',
        '<p>{text} <a href="/x">{short}</a> {text}</p>', '<ul><li>{text}</li><li>{short}</li></ul>',
        '<blockquote><p>{text}</p></blockquote>', '<h3>{short}</h3>', '<table><tr><td>{short}</td><td>{short}</td></tr></table>',
        '<p><em>{text}</em></p>', '<pre>{text}</pre>', '<div>{text}</div>', '<figure><figcaption>{text}</figcaption></figure>',
        '<section><p>{text}</p></section>', '<ol><li>{text}</li></ol>', '<p>{number}</p>')

Part = tuple[str, bool]


def _words(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    out = " ".join(words).capitalize()
    return out.replace(" ", ", ", 1) if rng.random() < 0.3 else out


def _fill(rng: random.Random, template: str) -> str:
    out = template
    while "{text}" in out:
        out = out.replace("{text}", _words(rng, 4, rng.choice((8, 20, 60))) + rng.choice(".. .!?"), 1)
    while "{short}" in out:
        out = out.replace("{short}", _words(rng, 1, 4), 1)
    while "{number}" in out:
        out = out.replace("{number}", f"{_words(rng, 2, 5)} {rng.randint(1, 99999)}.", 1)
    links = "".join(f'<a href="/{i}">{_words(rng, 1, 2)}</a> ' for i in range(rng.randint(2, 6)))
    items = "".join(f'<li><a href="/{i}">{_words(rng, 1, 2)}</a></li>' for i in range(rng.randint(2, 6)))
    return out.replace("{a}", links).replace("{li}", items)


def page(rng: random.Random) -> list[Part]:
    """The parts of one page."""
    def maybe(chance: float, *choices: tuple[str, ...]) -> list[Part]:
        return [(_fill(rng, rng.choice(c)), False) for c in choices if rng.random() < chance]

    parts: list[Part] = [("<html><body>", False)]
    if rng.random() < 0.15:
        parts.append((rng.choice(('<div id="page">', '<div class="wrapper">', '<div class="container">')), False))
    parts += maybe(0.6, NOTICE)[:1] if rng.random() < 0.4 else []
    parts += maybe(0.5, HEADER, NAV) + maybe(0.9, NAV)[:1] + maybe(0.35, ADVERT, SIDE, FORM, NOTICE)
    kind = rng.randrange(len(OPEN))
    parts.append((OPEN[kind], False))
    if rng.random() < 0.85:
        parts.append((f"<h1>{_words(rng, 1, 10)}</h1>", True))
    for _ in range(rng.choice((1, 2, 3, 5, 8, 12))):
        parts.append((_fill(rng, rng.choice(BODY)), True))
        if rng.random() < 0.25:
            parts += maybe(0.9, rng.choice((ADVERT, SIDE, FORM, NOTICE)))
    if rng.random() < 0.15:
        parts += maybe(1.0, COMMENT)
    parts.append((CLOSE[kind], False))
    parts += maybe(0.4, COMMENT) + maybe(0.3, SIDE, ADVERT, FORM, NOTICE, NAV) + maybe(0.85, FOOTER)
    if rng.random() < 0.9:
        parts.append(("</body></html>", False))
    return parts


def training_pages(n: int, seed: int = 11) -> list[list[Part]]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(n)]
