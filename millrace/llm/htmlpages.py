"""Labelled pages to train the extraction model on: many layouts, invented words, and the main text of each known.

The pages come from a seeded generator, so training needs no data and gives the same model everywhere.
"""

from __future__ import annotations

import random

SYLLABLES = "an ber cor dil eth fen gor hal ist jun kel lor men nor ost pra qui ren sol tir und ver wen yor zan mi la to re sa".split()

#: Names under which sites file each kind of region, in class or id.
NAMES = {
    "content": "article post content entry story main body text single page-content article-body post-content entry-content main-content story-body article__body blog-post".split(),
    "menu": "nav menu navbar navigation main-nav topnav breadcrumb breadcrumbs nav-links site-menu pagination pager tabs toc".split(),
    "header": "header masthead site-header page-header topbar banner branding logo tagline".split(),
    "footer": "footer site-footer page-footer copyright legal colophon bottom footer-links imprint".split(),
    "sidebar": "sidebar aside widget related sidebar-right secondary widgets trending popular recommended more-stories related-posts side rail".split(),
    "notice": "notice cookie cookies consent cookie-banner alert gdpr popup modal overlay privacy-notice message paywall".split(),
    "advert": "ad ads advert advertisement ad-slot sponsored promo banner-ad adsense sponsor promotion partner ad-banner".split(),
    "form": "form newsletter subscribe signup search login contact search-form newsletter-signup register".split(),
    "comments": "comments comment reader-comments commentlist comment-list responses discussion replies respond disqus comment-body reviews".split(),
    "share": "share social sharing share-buttons social-links tags meta byline author-box follow".split(),
}
TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "aside", "noscript"], "advert": ["div", "aside", "ins"], "form": ["form", "div"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}


class Maker:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.rng
        out = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        for i in range(len(out)):
            if r.random() < 0.08:
                out[i] += r.choice([",", ".", ";", " &amp;"])
        return " ".join(out).capitalize() + (r.choice([".", ".", "!", "?", ""]))

    def named(self, kind: str, tag: str) -> str:
        r = self.rng
        if r.random() < 0.15 and tag not in ("div", "ul", "ol", "section"):
            return f"<{tag}>"
        return f'<{tag} {r.choice(["class", "class", "class", "id"])}="{" ".join(r.sample(NAMES[kind], r.choice([1, 1, 2])))}">'

    def links(self, low: int, high: int) -> str:
        r = self.rng
        item = lambda: f'<a href="/{r.choice(SYLLABLES)}">{self.words(1, 3)}</a>'
        n = r.randint(low, high)
        return r.choice([lambda: "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(n)) + "</ul>", lambda: " | ".join(item() for _ in range(n)), lambda: "".join(f"<div>{item()}</div>" for _ in range(n))])()

    def paragraph(self, low: int = 1, high: int = 90) -> str:
        r = self.rng
        text = self.words(low, r.choice([4, 15, high, high]))
        if r.random() < 0.2:
            text += f' <a href="/x">{self.words(1, 3)}</a> {self.words(1, 12)}'
        if r.random() < 0.15:
            text = f"<b>{text}</b>" if r.random() < 0.5 else f"<b>{text}<br>"
        close = "</p>" if r.random() < 0.85 else ""
        return f"<p>{text}{close}"

    def piece(self, kind: str) -> str:
        """A region that is not main text."""
        r = self.rng
        tag = r.choice(TAGS[kind])
        start = self.named(kind, tag)
        if kind == "menu":
            inner = self.links(2, 9)
        elif kind == "header":
            inner = (f"<h1>{self.words(1, 4)}</h1>" if r.random() < 0.3 else f"<div>{self.words(1, 5)}</div>") + (self.links(1, 5) if r.random() < 0.5 else "")
        elif kind == "footer":
            inner = r.choice([f"&copy; {self.words(1, 12)}", f"<p>&copy; 2024 {self.words(2, 30)}</p>", f"{self.links(2, 6)}<p>{self.words(2, 15)}</p>", f"m.example.net &middot; {self.words(2, 10)}"])
        elif kind == "sidebar":
            inner = f"<h3>{self.words(1, 4)}</h3>" + (self.links(2, 7) if r.random() < 0.7 else f"<p>{self.words(5, 40)}</p>")
        elif kind == "notice":
            inner = f"<p>{self.words(5, 50)}</p>" + ("<button>Ok</button>" if r.random() < 0.5 else "") if r.random() < 0.6 else self.words(5, 40)
        elif kind == "advert":
            inner = r.choice([self.words(2, 20), f"<p>{self.words(2, 25)}</p>", f'<a href="/buy">{self.words(2, 10)}</a>'])
        elif kind == "form":
            inner = f'<label>{self.words(1, 5)}</label><input type="text">' + (f"<p>{self.words(3, 20)}</p>" if r.random() < 0.5 else "") + f"<button>{self.words(1, 2)}</button>"
        elif kind == "comments":
            item = r.choice(["div", "li", "article"])
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(f"{self.named('comments', item)}<p>{self.words(3, 60)}</p></{item}>" for _ in range(r.randint(1, 5)))
        else:
            inner = self.links(1, 5) if r.random() < 0.6 else self.words(1, 6)
        return f"{start}{inner}</{tag}>"

    def main(self) -> str:
        """The main text, in marks that the reader below takes out again."""
        r, out = self.rng, []
        if r.random() < 0.8:
            out.append(f"<h1>{self.words(1, 12)}</h1>")
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            x = r.random()
            if x < 0.72:
                out.append(self.paragraph())
            elif x < 0.8:
                out.append(f"<h2>{self.words(1, 7)}</h2>")
            elif x < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif x < 0.9:
                out.append(f"<blockquote><p>{self.words(3, 40)}</p></blockquote>")
            elif x < 0.93:
                out.append(f"<table><tr><th>{self.words(1, 3)}</th><td>{self.words(1, 8)}</td></tr></table>")
            elif x < 0.96:
                out.append(f"<pre>{self.words(3, 20)}</pre>")
            else:
                out.append(f"<div>{self.words(3, 60)}</div>")
            if r.random() < 0.07:
                out.append(f"<x-off>{self.piece(r.choice(['advert', 'share', 'sidebar', 'notice', 'form', 'menu']))}</x-off>")
        return "".join(out)

    def page(self) -> str:
        """HTML in which <x-on> and <x-off> enclose main and other text; the trainer drops these two tags."""
        r = self.rng
        some = lambda kinds, p: "".join(self.piece(k) for k in kinds if r.random() < p)
        tag = r.choice(["article", "article", "main", "div", "div", "section", "td"])
        start = f"<{tag}>" if r.random() < (0.6 if tag in ("article", "main") else 0.1) else self.named("content", tag)
        after = f"<x-off>{self.piece('comments')}</x-off>" if r.random() < 0.15 else ""
        body = f"<x-on>{start}{self.main()}{after}</{tag}></x-on>"
        if tag == "td":
            body = f"<table><tr>{body}</tr></table>"
        if r.random() < 0.35:
            wrap = r.choice(["div", "main", "section"])
            body = f'<{wrap} class="{r.choice(["wrapper", "container", "row", "layout", "page"])}">{some(["share"], 0.3)}{body}{some(["sidebar", "share"], 0.5)}</{wrap}>'
        return (
            "<!DOCTYPE html><html><head><title>" + self.words(1, 8) + "</title></head><body>"
            + some(["notice"], 0.3) + some(["header"], 0.6) + some(["menu"], 0.8) + some(["advert", "form", "advert"], 0.35)
            + body
            + some(["sidebar", "comments", "advert", "share", "form", "notice"], 0.35) + some(["footer"], 0.85) + some(["notice", "advert"], 0.1)
            + ("</body></html>" if r.random() < 0.9 else "")
        )


def training_pages(n: int = 800, seed: int = 20_240_504) -> list[str]:
    return [Maker(seed + i).page() for i in range(n)]
