"""Pages in many layouts made of given blocks, with the main text marked, to train the block labeller on."""

from __future__ import annotations

import html

import numpy as np

#: Names in the class of elements whose text is main text, and of those inside it whose text is not. Readers of the page drop them.
MAIN, SKIP = "zmain", "zskip"

# Usual names and phrases of page parts.
NAMES = {
    "main": "content article post entry story main-content article-body post-content entry-content story-body page-content text body-text articleText hentry blog-post news-item read".split(),
    "nav": "nav menu navbar navigation main-menu breadcrumb breadcrumbs topbar tabs top-nav navMenu pagination skip-links".split(),
    "header": "header masthead site-header branding logo top page-header head site-title hero".split(),
    "footer": "footer site-footer bottom legal copyright foot page-footer colophon credits imprint".split(),
    "sidebar": "sidebar aside widget related rail side-column recommended trending popular more-stories right-col teaser see-also tags".split(),
    "notice": "cookie consent notice alert gdpr cookie-banner popup modal warning cookie-notice privacy overlay banner message paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo ad-slot banner-ad adsbygoogle advertorial commercial".split(),
    "form": "form search login signup subscribe newsletter contact search-box register feedback-form".split(),
    "comments": "comments comment-list discussion replies responses reader-comments user-comments thread disqus comment-section talkback".split(),
    "share": "share social share-buttons follow sharing social-links toolbar".split(),
}
TAGS = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "main": "article", "notice": "div", "ad": "div", "comments": "section", "share": "div"}
PHRASES = {
    "nav": ["Home", "News", "Sport", "About us", "Contact", "Shop", "Blog", "Startseite", "Accueil", "Inicio", "Archive", "Products", "Next", "Previous", "1", "2"],
    "header": ["Daily News", "Welcome", "My site", "Log in", "The Journal", "Menu", "English", "Français"],
    "footer": ["© 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Impressum", "Mentions légales", "Sitemap", "Powered by our team", "Aviso legal"],
    "sidebar": ["Related articles", "Most read", "Popular posts", "See also", "Tags", "Trending now", "Meistgelesen", "À lire aussi", "Lo más leído", "More stories"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies.", "Reject", "Wir verwenden Cookies.", "Nous utilisons des cookies.", "Usamos cookies.", "Please enable JavaScript.", "Your browser is out of date.", "Subscribe to read on."],
    "ad": ["Advertisement", "Sponsored", "Buy now and save 50%!", "Anzeige", "Publicité", "Publicidad", "Special offer", "Order today"],
    "form": ["Search", "E-mail", "Password", "Send", "Subscribe", "Name", "Sign up for our newsletter", "Submit", "Your message"],
    "comments": ["Comments", "3 comments", "Leave a reply", "Reply", "Kommentare", "Commentaires", "Comentarios", "Posted by guest", "Anna wrote:", "Report", "12 likes", "2 days ago"],
    "share": ["Share", "Tweet", "Facebook", "Print", "E-mail this", "Teilen", "Partager", "Compartir", "Like"],
}


def varied_page(main: list[str], other: list[str], r: np.random.Generator) -> str:
    """A page that shows ``main`` as its article, among other parts made of usual phrases, ``other`` and words of ``main``.

    Parts come as their own elements, as named or as plain ones, before, after and inside the article.
    """
    style = r.choice(["elements", "names", "both", "plain"], p=[0.3, 0.3, 0.3, 0.1])
    words = " ".join(main + other).split() or ["text"]

    def text(value: str) -> str:
        return html.escape(value, quote=False)

    def pick(n: int) -> str:
        at = int(r.integers(0, len(words)))
        return " ".join(words[at:at + n]) or words[0]

    def element(kind: str, inner: str, mark: str = "", named: bool = False) -> str:
        tag = TAGS[kind] if style in ("elements", "both") else str(r.choice(["div", "section", "div", "ul"] if kind != "main" else ["div", "section", "div", "td"]))
        names = [str(x) for x in r.choice(NAMES[kind], int(r.integers(1, 3)))] if named or style in ("names", "both") else []
        where = "id" if names and r.random() < 0.2 else "class"
        if kind == "main" and style == "elements" and r.random() < 0.3:
            tag = "main"
        wrapped = f'<div class="{mark}">{inner}</div>' if mark else inner
        made = f'<{tag} {where}="{" ".join(names)}">{wrapped}</{tag}>' if names else f"<{tag}>{wrapped}</{tag}>"
        return f"<table><tr>{made}</tr></table>" if tag == "td" else made

    def phrase(kind: str) -> str:
        u = r.random()
        if u < 0.5:
            return text(str(r.choice(PHRASES[kind])))
        if u < 0.7 and other:
            return text(other[int(r.integers(0, len(other)))])
        return text(pick(int(r.integers(1, 5 if kind in ("nav", "share", "form") else 14))))

    def part(kind: str, named: bool = False) -> str:
        n = int(r.integers(1, 8))
        if kind in ("nav", "share"):
            items = [f'<a href="/{k}">{phrase(kind)}</a>' for k in range(n)]
            inner = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if r.random() < 0.7 else " ".join(items)
        elif kind == "form":
            inner = "".join(f"<label>{phrase(kind)}</label><input name=q>" if r.random() < 0.5 else f"<p>{phrase(kind)}</p>" for _ in range(n % 3 + 1)) + f"<button>{phrase(kind)}</button>"
        elif kind == "comments":
            title = f"<h3>{text(str(r.choice(PHRASES['comments'][:7])))}</h3>" if r.random() < 0.8 else ""
            inner = title + "".join(f"<div><b>{text(pick(1))}</b><p>{text(pick(int(r.integers(3, 40))))}</p>" + (f"<a href=#>{phrase(kind)}</a>" if r.random() < 0.6 else "") + "</div>" for _ in range(n % 5 + 1))
        elif kind == "sidebar":
            title = f"<h4>{phrase(kind)}</h4>" if r.random() < 0.7 else ""
            inner = title + ("<ul>" + "".join(f'<li><a href="/{k}">{text(pick(int(r.integers(2, 9))))}</a></li>' for k in range(n)) + "</ul>" if r.random() < 0.7 else f"<p>{text(pick(20))}</p>" * (n % 2 + 1))
        elif kind == "header":
            inner = (f"<h1>{phrase(kind)}</h1>" if r.random() < 0.3 else f"<a href=/>{phrase(kind)}</a>") + (f"<p>{phrase(kind)}</p>" if r.random() < 0.5 else "")
        else:
            inner = "".join(f"<p>{phrase(kind)}</p>" if r.random() < 0.5 else phrase(kind) for _ in range(1 if kind == "ad" else n % 3 + 1))
        return element(kind, inner, named=named)

    def marked(kind: str) -> str:
        return f'<div class="{SKIP}">{part(kind, kind not in ("form", "sidebar") or style == "plain")}</div>'  # named, else nothing tells it from the article

    body = []
    for k, value in enumerate(main):
        shown = text(value)
        u = r.random()
        if k == 0 and u < 0.7:
            body.append(f"<h1>{shown}</h1>")
        elif u < 0.08:
            body.append(f"<h2>{shown}</h2>")
        elif u < 0.15:
            body.append(f"<ul><li>{shown}</li><li>{text(pick(6))}</li></ul>")
        elif u < 0.2:
            body.append(f"<blockquote>{shown}</blockquote>")
        elif u < 0.24:
            body.append(f"<table><tr><td>{shown}</td><td>{text(pick(3))}</td></tr></table>")
        elif u < 0.28:
            body.append(f"<figure><img src=x><figcaption>{shown}</figcaption></figure>")
        elif u < 0.36:
            body.append(f"<div>{shown}</div>")
        elif u < 0.44:
            cut = shown.split(" ")
            cut[len(cut) // 2] = f'<a href="/x">{cut[len(cut) // 2]}</a>'
            body.append(f"<p>{' '.join(cut)}</p>")
        else:
            body.append(f"<p>{shown}</p>" if r.random() < 0.8 else f"<p>{shown}")
        if r.random() < 0.25:
            body.append(f"<p>{text(pick(int(r.integers(1, 6))))}</p>" * (int(r.integers(2, 6)) if r.random() < 0.15 else 1))
        if r.random() < 0.06:
            body.append(marked(str(r.choice(["ad", "sidebar", "share", "form", "notice"]))))
    if r.random() < 0.3:
        body.append(marked(str(r.choice(["share", "sidebar", "comments"]))))
    front = [part(k) for k in ("notice", "header", "nav", "ad", "form", "sidebar", "share") if r.random() < (0.75 if k in ("header", "nav") else 0.3)]
    if r.random() < 0.3:
        r.shuffle(front)
    back = [part(k) for k in ("share", "comments", "sidebar", "ad", "form", "nav", "footer", "notice") if r.random() < (0.8 if k == "footer" else 0.45 if k in ("comments", "sidebar") else 0.2)]
    page = "".join(front) + element("main", "".join(body), MAIN) + "".join(back)
    for _ in range(int(r.integers(0, 3))):
        page = f"<div{' class=' + chr(34) + str(r.choice(['wrap', 'container', 'page', 'row', 'site', 'inner'])) + chr(34) if style != 'plain' else ''}>{page}</div>"
    return f"<html><head><title>{text(pick(5))}</title></head><body>{page}</body></html>"
