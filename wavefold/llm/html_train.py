"""Fit the block labeller of `html_extract` on pages made here, whose article is known.

    python -m wavefold.llm.html_train

Pages are composed from parts in many orders, element names and class names:
the article, and around and inside it menus, headers, footers, sidebars,
notices, adverts, forms, reader comments and lists of other articles. Words are
made up from random syllables, with function words of real languages and some
made up for each page between them, so that the model learns tag paths, the shape
of blocks and their order, and only the stock words of boilerplate as words. Some
notices, adverts and comments stand in plain elements, where only their words
tell them; in turn some article text uses a few of those words.
Writes ``html_model.npz``; the same seed gives the same weights.
"""

from __future__ import annotations

import random
from itertools import accumulate
from pathlib import Path

import numpy as np

from wavefold.llm.html_extract import KEPT_ABOVE, WIDTH, Labeller, blocks, vectors

SEED, PAGES, HELD_OUT, EPOCHS, BATCH, HIDDEN, RATE = 7, 24_000, 400, 6, 24, 24, 4e-3
#: Share of articles with blocks that only their words tell apart.
PLAIN_SHARE = 0.4
#: Weight of a block of the article in the loss: text that is lost is worse than a notice that is kept.
LOST = 40
#: Marks article text in a made page; cut out before the page is used.
MARK = "⁣"

ARTICLE = ["<article>", '<article class="post">', "<main>", '<main id="main"><article>', '<div class="content">', '<div id="content">',
           '<div class="post-content">', '<section class="entry">', '<div class="article-body">', '<div itemprop="articleBody">',
           '<div class="story">', '<article class="hentry"><div class="entry-content">', '<div class="text">', '<div role="main">',
           '<div id="article">', '<section class="body">', "<table><tr><td>", '<div class="page"><div class="main">', "<article><section>"]
SIDE = ["<aside>", '<aside class="sidebar">', '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<div class="side-bar right">',
        '<div role="complementary">', '<section class="related">', '<div class="recommended">', '<div class="trending">', '<div class="most-read">',
        '<div class="author-box">', '<div class="tags">', '<div class="share">', '<div class="social-links">']
NOTICE = ['<div class="notice">', '<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="alert">', '<div role="alert">',
          '<div class="gdpr consent">', '<div class="banner">', '<div class="popup">', '<div class="disclaimer">', '<p class="notice">',
          '<div class="paywall">', '<div class="message">', '<section class="notice">', '<div class="newsletter">', '<div class="subscribe">']
ADVERT = ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">',
          '<div class="promo">', '<div id="ad-top">', '<aside class="ad">', '<div class="banner-ad">', '<p class="ad">', '<div class="ad-slot">',
          '<section class="promoted">', '<div class="adsbox">', '<span class="ad">', '<ins class="adsbygoogle">']
COMMENTS = ['<section class="comments">', '<section id="comments">', '<div class="comments">', '<div id="comments">', '<ol class="commentlist">',
            '<div class="comment-thread">', '<div class="discussion">', '<div id="disqus_thread">', '<ul class="comment-list">',
            '<div class="responses">', '<div class="replies">', '<section class="reader-comments">', '<div class="user-comments">']
HEADER = ["<header>", '<header class="site-header">', '<div id="header">', '<div class="masthead">', '<div role="banner">', '<div class="top-bar">']
FOOTER = ["<footer>", '<footer class="site-footer">', '<div id="footer">', '<div class="footer">', '<div role="contentinfo">', '<div class="bottom">']
MENU = ["<nav>", '<nav class="menu">', '<div class="nav">', '<div id="menu">', '<ul class="menu">', '<div class="navbar">', '<div role="navigation">',
        '<div class="breadcrumbs">', '<ol class="breadcrumb">', '<div class="pagination">']
FORM = ["<form>", '<form class="search">', '<form action="/go" method="post">', '<div class="search-box"><form>', '<div class="login"><form>',
        '<div class="signup-form">', '<form class="newsletter">', '<form id="comment-form">']
STOCK = {
    "notice": ["We use cookies to improve this site.", "Please accept our terms.", "Subscribe to read more.", "This site uses cookies."],
    "advert": ["Advertisement", "Sponsored", "Buy now!", "Special offer", "Ad"],
    "comments": ["Comments", "Leave a reply", "3 comments", "Reader comments", "Reply", "Join the discussion"],
    "side": ["Related", "Most read", "Read more", "Popular posts", "About the author", "Tags", "Share this"],
    "footer": ["© 2024", "All rights reserved.", "Privacy policy", "Contact us", "Imprint", "&copy; example.com &middot;"],
    "form": ["Search", "Log in", "E-mail", "Name", "Submit", "Send", "Password", "Sign up"],
    "menu": ["Home", "News", "Sports", "About", "Contact", "Next", "Previous"],
}
# Blocks that nothing but their words tells apart: sentences that are put together.
PLAIN = {
    "notice": [
        "We use cookies to give you the best experience on our website.", "By continuing to browse you accept our use of cookies.",
        "Read our cookie policy and privacy policy to learn how your personal data is processed.", "You can change your cookie settings at any time.",
        "This website stores cookies on your device.", "Accept all cookies or manage your consent preferences.",
        "You have reached your limit of free articles.", "Subscribe now for unlimited access to this website.", "Log in or register to continue reading.",
        "Sign up for our newsletter and get updates in your inbox.", "Please disable your ad blocker to support this website.",
        "Please enable JavaScript in your browser to view this website.", "Already a subscriber? Log in to your account.",
        "Wir verwenden Cookies, um Ihnen die beste Nutzung unserer Webseite zu ermöglichen.", "Bitte akzeptieren Sie unsere Datenschutzerklärung und Cookies.",
        "Nous utilisons des cookies pour améliorer votre expérience sur notre site.", "Veuillez accepter notre politique de confidentialité et les cookies.",
        "Utilizamos cookies para mejorar su experiencia en nuestro sitio web.", "Acepte nuestra política de privacidad y el uso de cookies."],
    "advert": [
        "Buy now and save up to fifty percent with free shipping.", "Special offer: order today and get a discount.", "Shop the sale now while stocks last.",
        "Advertisement: our sponsor offers the best price on the market.", "This is sponsored content paid by our partner.",
        "Sleep better with our new mattress, order now for a free trial.", "Click here to claim your exclusive discount code.",
        "Compare prices and find cheap deals on insurance and loans.", "Best deals of the week, free delivery on all orders.",
        "Limited time offer, buy one and get one free.", "Try it free for thirty days, money back guarantee.", "Use the coupon code at checkout for a discount on your order.",
        "Jetzt kaufen und sparen, kostenloser Versand bei jeder Bestellung.", "Anzeige: unser Angebot zum besten Preis.",
        "Achetez maintenant et profitez de la livraison gratuite.", "Publicité : offre spéciale, prix réduit sur votre commande.",
        "Compre ahora y ahorre con envío gratis.", "Publicidad: oferta especial con descuento en su pedido."],
    "comments": [
        "Thanks for sharing this great post, I really enjoyed reading it.", "Great article, thanks for posting!", "I totally agree with you, nice comment.",
        "I disagree with the author of this article, sorry.", "Can someone please explain this to me?", "Posted by a reader two hours ago. Reply. Report this comment.",
        "Leave a comment or reply to this post below.", "LOL, I love this, thank you so much for the article!", "You must be logged in to post a comment.",
        "Thank you for writing this post, very helpful article.", "Reply to this comment, share, like, report abuse.", "First comment! I love your blog.",
        "Vielen Dank für den tollen Artikel, ich stimme dem Kommentar zu.", "Kommentar melden, antworten, gefällt mir.",
        "Merci pour cet excellent article, je suis d'accord avec ce commentaire.", "Répondre à ce commentaire, signaler un abus.",
        "Gracias por compartir este artículo, me gusta mucho.", "Responder a este comentario, denunciar."],
}
TELLING = sorted({w.strip(".,!?:") for kind in PLAIN.values() for text in kind for w in text.split() if len(w) > 3})
# Words that any text is full of.
FUNCTION = [x.split() for x in (
    "the of and to in a is that for it was on are as with his they at be this have from or one had by but not what all were we when your can there you our i",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er aus bei nach wie wir ihr sie ich",
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou nous vous je",
    "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le nos usted yo")]
SYLLABLES = "ba de fi go lu ma ne pi ro sa te vi an er in or th en ch ion ment ein é ñ ü ß st ou ar ie".split()
LETTERS = "eeeeaaaiiioountrsshdlcmfgpbwvykzéèçñüöä"


class Maker:
    """``plain``: share of articles with blocks in or after them that only words tell apart."""

    def __init__(self, seed: int, plain: float = 0.0):
        self.r = random.Random(seed)
        self.share, self.frequent, self.steps, self.often, self.syllables = plain, [], [], 0.0, SYLLABLES

    def language(self) -> None:
        """A page's syllables, and its frequent words: a real language's or made up, and how frequent they are."""
        self.syllables = ["".join(self.r.choices(LETTERS, k=self.r.randint(1, 4))) for _ in range(self.r.randint(10, 60))] + SYLLABLES
        self.often = self.r.choice([0.0, 0.3, 0.5, 0.7])
        frequent = [self._made() for _ in range(self.r.randint(5, 40))] if self.r.random() < 0.3 else list(self.r.choice(FUNCTION))
        if self.r.random() < 0.6:
            self.r.shuffle(frequent)
        steep = self.r.uniform(0, 1.3)
        self.frequent, self.steps = frequent, list(accumulate((k + 1) ** -steep for k in range(len(frequent))))

    def _made(self) -> str:
        return "".join(self.r.choices(self.syllables, k=self.r.randint(1, 4)))

    def word(self) -> str:
        return self.r.choices(self.frequent, cum_weights=self.steps)[0] if self.r.random() < self.often else self._made()

    def plain(self) -> str:
        """A notice, advert or comment without a telling element: its words stand anywhere in it."""
        kind = self.r.choice(list(PLAIN))
        text = " ".join(self.r.choices(PLAIN[kind], k=self.r.choice([1, 1, 2, 2, 3])))
        before = self.words(1, 6) + self.r.choice([" ", ". ", ": "]) if self.r.random() < 0.5 else ""
        after = " " + self.words(1, 6) + self.r.choice([".", "", "!"]) if self.r.random() < 0.5 else ""
        return f"{before}{text}{after}"

    def words(self, low: int, high: int) -> str:
        out = " ".join(self.word() for _ in range(self.r.randint(low, high)))
        return out[:1].upper() + out[1:]

    def prose(self, sentences: int) -> str:
        return " ".join(self.words(2, 16) + self.r.choice("....!?") for _ in range(sentences))

    def inline(self, text: str) -> str:
        if self.r.random() < 0.25 and " " in text:
            words, tag = text.split(" "), self.r.choice(["b", "i", "em", "strong", 'a href="/x"', "span", "code"])
            at = self.r.randrange(len(words))
            words[at] = f"<{tag}>{words[at]}</{tag.split()[0]}>"
            text = " ".join(words)
        return text

    def close(self, opening: str) -> str:
        tags = [t.split()[0].strip("<>") for t in opening.replace("><", ">\n<").split("\n")]
        return "".join(f"</{t}>" for t in reversed(tags))

    def within(self, opening: str, inside: str) -> str:
        return opening + inside + (self.close(opening) if self.r.random() < 0.97 or "<p" in opening else "</div>" if "div" in opening else self.close(opening))

    def links(self, kind: str) -> str:
        items = [self.r.choice(STOCK[kind]) if self.r.random() < 0.2 else self.words(1, 4) for _ in range(self.r.randint(2, 9))]
        if self.r.random() < 0.6:
            return "<ul>" + "".join(f'<li><a href="/{k}">{t}</a></li>' for k, t in enumerate(items)) + "</ul>"
        return self.r.choice([" ", " | ", ""]).join(f'<a href="/{k}">{t}</a>' for k, t in enumerate(items))

    def small(self, kind: str) -> str:
        """A few lines as they stand in notices, adverts and sidebars."""
        out = []
        if self.r.random() < 0.4:
            out.append(f"<{(t := self.r.choice(['h3', 'h4', 'b', 'p', 'div']))}>{self.r.choice(STOCK[kind])}</{t}>")
        for _ in range(self.r.randint(1, 3)):
            text = self.prose(self.r.choice([1, 1, 2, 5])) if self.r.random() < 0.7 else self.words(1, 8)
            out.append(text if self.r.random() < 0.4 else f"<p>{self.inline(text)}</p>")
        if self.r.random() < 0.25:
            out.append(self.links("side"))
        return "".join(out)

    def comments(self) -> str:
        out = [f"<{(t := self.r.choice(['h2', 'h3', 'h4']))}>{self.r.choice(STOCK['comments'])}</{t}>"] if self.r.random() < 0.6 else []
        item = self.r.choice(['<div class="comment">', '<li class="comment">', "<li>", "<article>", '<article class="comment">', "<p>", "<div>",
                              "<blockquote>", '<div class="reply">'])
        for _ in range(self.r.randint(1, 5)):
            text = self.prose(self.r.choice([1, 2, 3, 8]))
            name = self.r.choice(["", f"<b>{self.word()}</b> ", f'<span class="author">{self.word()}</span>', f"<cite>{self.word()}</cite>: "])
            out.append(item + name + (text if item == "<p>" or self.r.random() < 0.5 else f"<p>{text}</p>") + self.close(item))
        if self.r.random() < 0.3:
            out.append(self.form())
        return self.within(self.r.choice(COMMENTS), "".join(out))

    def form(self) -> str:
        out = []
        for _ in range(self.r.randint(1, 4)):
            t = self.r.choice(STOCK["form"]) if self.r.random() < 0.5 else self.words(1, 4)
            out.append(self.r.choice([f"<label>{t}</label><input>", f"<button>{t}</button>", f"<p>{t} <input name=q></p>", f"<legend>{t}</legend>",
                                      f"<select><option>{t}</option><option>{self.word()}</option></select>", f"<textarea>{t}</textarea>",
                                      f"<p>{self.prose(1)}</p>", f"<div>{t}</div>"]))
        return self.within(self.r.choice(FORM), "".join(out))

    def junk(self, inside: bool) -> str:
        kind = self.r.choice(["side", "notice", "advert", "advert", "form"] if inside else ["side", "notice", "advert", "form", "menu", "hidden"])
        if kind == "form":
            return self.form()
        if kind == "menu":
            return self.within(self.r.choice(MENU), self.links("menu"))
        if kind == "hidden":
            return self.r.choice(["<script>var a='<p>" + self.word() + "</p>';</script>", "<style>p{color:red}</style>", f"<!-- {self.words(1, 9)} -->",
                                  "<noscript><p>Enable scripts</p></noscript>"])
        return self.within(self.r.choice({"side": SIDE, "notice": NOTICE, "advert": ADVERT}[kind]), self.small(kind))

    def article(self) -> str:
        m = lambda t: MARK + t
        out = []
        odd = self.share and self.r.random() < self.share
        title = self.words(1, 12)
        if self.r.random() < 0.85:
            head = f"<h1>{m(title)}</h1>"
            out.append(f"<header>{head}</header>" if self.r.random() < 0.15 else head)
        if self.r.random() < 0.35:
            out.append(f"<p><b>{m(title + self.r.choice(['', '.']) + ' ' + self.prose(self.r.randint(0, 2)))}<br>")
        lone = self.r.random() < 0.1
        for _ in range(1 if lone else self.r.choice([1, 2, 3, 5, 8, 12])):
            kind = self.r.random()
            if kind < 0.70:
                text = self.prose(self.r.choice([1, 1, 2, 4, 7])) if self.r.random() < 0.9 else self.words(1, 3)
                if self.share and self.r.random() < 0.1 and len(words := text.split(" ")) > 12:
                    for _ in range(self.r.randint(1, len(words) // 6)):  # prose may use some of the words, too
                        words[self.r.randrange(len(words))] = self.r.choice(TELLING)
                    text = " ".join(words)
                if self.share and (form := self.r.random()) < 0.06:
                    text = " ".join([self.word()] * self.r.randint(2, 60)) if form < 0.03 else " | ".join(text.split(" "))
                if self.r.random() < 0.06:
                    text = " ".join(w + self.r.choice(["%%%", "###", "***", "$$$", "&amp;&amp;", "!!"]) for w in text.split())
                out.append(self.r.choice([f"<p>{m(self.inline(text))}</p>"] * 8 + [f"<div>{m(text)}</div>", f"<p>{m(text)}<p>{m(self.prose(1))}",
                                         f"<p><b>{m(text)}<br>", f"{m(text)}<br>"]))
            elif kind < 0.8:
                out.append(f"<{(t := self.r.choice(['h2', 'h3', 'h4']))}>{m(self.words(1, 8))}</{t}>")
            elif kind < 0.9:
                list_ = self.r.choice(["ul", "ol"])
                out.append(f"<{list_}>" + "".join(f"<li>{m(self.inline(self.prose(1) if self.r.random() < 0.5 else self.words(1, 6)))}</li>"
                                                   for _ in range(self.r.randint(1, 5))) + f"</{list_}>")
            elif kind < 0.95:
                out.append(self.r.choice([f"<blockquote>{m(self.prose(2))}</blockquote>", f"<blockquote><p>{m(self.prose(2))}</p></blockquote>",
                                          f"<pre>{m(self.words(3, 20))}</pre>", f"<figure><img src=x><figcaption>{m(self.words(3, 9))}</figcaption></figure>",
                                          f"<table><tr><th>{m(self.word())}</th><td>{m(self.words(1, 5))}</td></tr></table>"]))
            elif self.r.random() < 0.7:
                out.append(self.junk(inside=True))
            if odd and self.r.random() < 0.3:
                out.append(self.r.choice(["<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<div><p>{}</p></div>"]).format(self.plain()))
        if self.r.random() < 0.08:
            out.append(self.comments())
        opening = self.r.choice(ARTICLE)
        if self.r.random() < 0.4:
            opening = "<article>"
        return self.within(opening, "".join(out))

    def page(self) -> str:
        if self.share:
            self.language()
        title = self.words(2, 9)
        around = lambda low, high: [self.junk(False) for _ in range(self.r.randint(low, high))]
        body = []
        if self.r.random() < 0.5:
            body.append(self.within(self.r.choice(HEADER), self.r.choice([f"<a href=/>{self.word()}</a>", f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 7)}</p>",
                                                                          f"<h2>{self.words(1, 4)}</h2><p>{self.prose(1)}</p>"])
                                    + (self.within("<nav>", self.links("menu")) if self.r.random() < 0.4 else "")))
        if self.r.random() < 0.8:
            body.append(self.within(self.r.choice(MENU), self.links("menu")))
        body += around(0, 3)
        if self.r.random() < 0.96:
            body.append(self.article())
            if self.share and self.r.random() < self.share / 2:
                body += [self.r.choice(["<p>{}</p>", "<div>{}</div>", "<div><p>{}</p></div>"]).format(self.plain())
                         for _ in range(self.r.randint(1, 3))]
        if self.r.random() < 0.35:
            body.append(self.comments())
        body += around(0, 3)
        if self.r.random() < 0.8:
            inside = f"{self.r.choice(STOCK['footer'])} {self.words(1, 12) if self.r.random() < 0.6 else self.prose(self.r.randint(1, 2))}"
            body.append(self.within(self.r.choice(FOOTER), self.r.choice([inside, f"<p>{inside}</p>", inside + self.links("menu")])))
        wrap = self.r.choice(["", "", "", '<div class="wrapper">', '<div id="page"><div class="container">', '<div class="layout">'])
        inner = "".join(body)
        inner = self.within(wrap, inner) if wrap else inner
        end = "</body></html>" if self.r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{inner}{end}"


def cases(seed: int, n: int, plain: float = 0.0) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors of the blocks of made pages, and which of them are article text."""
    maker, xs, ys, buckets = Maker(seed, plain), [], [], {}
    for _ in range(n):
        found = blocks(maker.page())
        y = np.array([MARK in b.text for b in found], np.float32)
        for b in found:
            b.text = b.text.replace(MARK, "") or "x"
        xs.append(vectors(found, buckets))
        ys.append(y)
    return xs, ys


def _lstm(x, wx, wh, b, mask):
    """Forward pass that keeps what the backward pass needs; gates are (input, forget, output, new)."""
    n, t, _ = x.shape
    hs = wh.shape[0]
    gates = (x.reshape(n * t, -1) @ wx + b).reshape(n, t, -1)
    h, c, kept = np.zeros((n, hs), np.float32), np.zeros((n, hs), np.float32), []
    out = np.empty((n, t, hs), np.float32)
    for k in range(t):
        z = gates[:, k] + h @ wh
        s, g = 1 / (1 + np.exp(-z[:, :3 * hs])), np.tanh(z[:, 3 * hs:])
        new = s[:, hs:2 * hs] * c + s[:, :hs] * g
        tc, on = np.tanh(new), mask[:, k, None]
        kept.append((h, c, s, g, tc, on))
        c, h = np.where(on, new, c), np.where(on, s[:, 2 * hs:] * tc, h)
        out[:, k] = h
    return out, kept


def _lstm_back(dout, x, wh, kept):
    n, t, hs = dout.shape
    dh, dc, dwh = np.zeros((n, hs), np.float32), np.zeros((n, hs), np.float32), np.zeros_like(wh)
    dz_all = np.zeros((n, t, 4 * hs), np.float32)
    for k in range(t - 1, -1, -1):
        h, c, s, g, tc, on = kept[k]
        i, f, o = s[:, :hs], s[:, hs:2 * hs], s[:, 2 * hs:]
        dh = dh + dout[:, k]
        dh_on = np.where(on, dh, 0)
        dnew = np.where(on, dc, 0) + dh_on * o * (1 - tc * tc)
        dz = np.concatenate((dnew * g * i * (1 - i), dnew * c * f * (1 - f), dh_on * tc * o * (1 - o), dnew * i * (1 - g * g)), axis=1)
        dz_all[:, k] = dz
        dwh += h.T @ dz
        dh, dc = np.where(on, dz @ wh.T, dh), np.where(on, dnew * f, dc)
    flat = dz_all.reshape(n * t, -1)
    return x.reshape(n * t, -1).T @ flat, dwh, flat.sum(axis=0)


def fit(xs: list[np.ndarray], ys: list[np.ndarray], seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights by Adam on the weighted mean log-loss of a block."""
    rng = np.random.default_rng(seed)
    shapes = {"fx": (WIDTH, 4 * HIDDEN), "fh": (HIDDEN, 4 * HIDDEN), "fb": (4 * HIDDEN,), "bx": (WIDTH, 4 * HIDDEN),
              "bh": (HIDDEN, 4 * HIDDEN), "bb": (4 * HIDDEN,), "wf": (HIDDEN,), "wb": (HIDDEN,), "bias": (1,)}
    w = {k: (rng.normal(0, 0.08, s) if k not in ("fb", "bb", "bias") else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    for k in ("fb", "bb"):
        w[k][HIDDEN:2 * HIDDEN] = 1.0  # remember at first
    m1, m2, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    full = [k for k in range(len(xs)) if len(xs[k])]
    for epoch in range(EPOCHS):
        order = sorted(full, key=lambda k: (len(xs[k]) + rng.integers(0, 8)))
        batches = [order[k:k + BATCH] for k in range(0, len(order), BATCH)]
        rng.shuffle(batches)
        loss = 0.0
        for batch in batches:
            t = max(len(xs[k]) for k in batch)
            x, y, mask = np.zeros((len(batch), t, WIDTH), np.float32), np.zeros((len(batch), t), np.float32), np.zeros((len(batch), t), bool)
            for i, k in enumerate(batch):
                n = len(xs[k])
                x[i, :n], y[i, :n], mask[i, :n] = xs[k], ys[k], True
            x *= rng.random(x.shape) > 0.08  # hide some features, so that no single name decides
            back = np.ascontiguousarray(x[:, ::-1])
            f, keep_f = _lstm(x, w["fx"], w["fh"], w["fb"], mask)
            b, keep_b = _lstm(back, w["bx"], w["bh"], w["bb"], mask[:, ::-1])
            z = f @ w["wf"] + b[:, ::-1] @ w["wb"] + w["bias"]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            weight = mask * np.where(y > 0, LOST, 1)
            total = weight.sum()
            loss += float(-(np.log(np.where(y > 0, p, 1 - p) + 1e-7) * weight).sum() / total)
            dz = ((p - y) * weight / total).astype(np.float32)
            g = {"wf": (f * dz[:, :, None]).sum((0, 1)), "wb": (b[:, ::-1] * dz[:, :, None]).sum((0, 1)), "bias": dz.sum(keepdims=True).reshape(1)}
            g["fx"], g["fh"], g["fb"] = _lstm_back(dz[:, :, None] * w["wf"], x, w["fh"], keep_f)
            g["bx"], g["bh"], g["bb"] = _lstm_back((dz[:, :, None] * w["wb"])[:, ::-1], back, w["bh"], keep_b)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k in w:
                v = g[k] * min(1.0, 1.0 / (norm + 1e-6))
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                w[k] -= (rate * m1[k] / (np.sqrt(m2[k]) + 1e-8)).astype(np.float32)
        print(f"epoch {epoch}: loss {loss / len(batches):.4f}", flush=True)
    return {k: v.astype(np.float16) for k, v in w.items()}


def accuracy(weights: dict[str, np.ndarray], xs: list[np.ndarray], ys: list[np.ndarray]) -> tuple[float, float]:
    """Shares of blocks, and of whole pages, labelled right."""
    right = [(s > KEPT_ABOVE) == (y > 0) for s, y in zip(Labeller(weights).scores(xs), ys)]
    return float(np.concatenate(right).mean()), float(np.mean([r.all() for r in right]))


def main() -> None:
    weights = fit(*cases(SEED, PAGES, PLAIN_SHARE))
    for plain in (0.0, PLAIN_SHARE):
        print("held out, plain %.1f: blocks %.4f, whole pages %.4f" % (plain, *accuracy(weights, *cases(SEED + 1, HELD_OUT, plain))))
    np.savez_compressed(Path(__file__).with_name("html_model.npz"), **weights)


if __name__ == "__main__":
    main()
