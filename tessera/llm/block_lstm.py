"""HTML main text: a recurrent block labeller.

A page is cut into leaf blocks (:mod:`tessera.llm.html_blocks`). Each block becomes a
vector of its hashed tag path, its hashed words and a few shares; a bidirectional LSTM
in numpy reads the whole sequence in both directions, so every block is classified with
the context of the whole document. Blocks labelled as main text are joined by two line
feeds.

Training pages come from a bounded sample (``max_pages`` pages by keyed hash of
page_id). Blocks inside ``article`` or ``main``, and outside of navigation, asides,
forms and the like, are main text there; further training pages re-lay the same texts
in other layouts (plain divisions, tables, sidebars, notices, comment sections, forms),
with class names present or absent. Defined results: null, empty or text-free pages give
the empty text; a table without any page trains on fixed sentences alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Interned, digest64
from tessera.llm.html_blocks import Block, blocks

PATH_DIM, WORD_DIM, SHARES = 48, 24, 7
WIDTH = PATH_DIM + WORD_DIM + SHARES
PAGES = 256  # pages labelled at a time

# Element names that hold no main text, and texts for a table without pages.
ASIDE_TAGS = frozenset("nav aside footer header form button menu dialog head title".split())
SENTENCES = ("A plain sentence stands here.", "Another one follows it, with a few more words.", "Short text.")


@dataclass(frozen=True)
class Settings:
    hidden: int = 20
    max_pages: int = 240  # bound on the training sample
    variants: int = 3  # re-laid pages for each sampled one
    epochs: int = 12
    batch: int = 24
    rate: float = 0.01
    seed: int = 5


def _signed(name: str, dim: int) -> tuple[int, float]:
    h = digest64(name)
    return h % dim, 1.0 if h >> 63 else -1.0


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_DIM)
    for name in path:  # two buckets a name: collisions rarely hide both
        for salt in ("p0 ", "p1 "):
            i, sign = _signed(salt + name, PATH_DIM)
            v[i] += sign
    return v


class Features:
    """Block vectors, with bounded caches of path and word hashes."""

    def __init__(self):
        self.paths = Interned(_path_vector, 50_000)
        self.words = Interned(self._code, 1_000_000)

    @staticmethod
    def _code(word: str) -> int:
        bucket, sign = _signed("w " + word, WORD_DIM)
        return bucket if sign > 0 else bucket + WORD_DIM

    def of(self, pages: Sequence[Sequence[Block]]) -> list[np.ndarray]:
        """One matrix for each page, a row for each block."""
        flat = [b for page in pages for b in page]
        if not flat:
            return [np.zeros((0, WIDTH)) for _ in pages]
        split = [b.text.lower().split(" ") for b in flat]
        n_words = np.array([len(w) for w in split])
        n_chars = np.array([len(b.text) for b in flat])
        cache = self.words
        codes = np.fromiter((cache[w] for words in split for w in words), np.int64, n_words.sum())
        counts = np.bincount(np.repeat(np.arange(len(flat)), n_words) * (2 * WORD_DIM) + codes,
                             minlength=len(flat) * 2 * WORD_DIM).reshape(len(flat), 2, WORD_DIM)
        bag = (counts[:, 0] - counts[:, 1]).astype(float)
        x = np.empty((len(flat), WIDTH))
        x[:, :PATH_DIM] = [self.paths[b.path] for b in flat]
        x[:, PATH_DIM:PATH_DIM + WORD_DIM] = bag / (1 + np.sqrt((bag ** 2).sum(1, keepdims=True)))
        sizes = [len(p) for p in pages]
        place = np.concatenate([np.arange(n) for n in sizes])
        last = np.repeat(np.maximum(np.array(sizes) - 1, 1), sizes)
        x[:, -SHARES:] = np.stack((
            np.log1p(n_words) / 3, np.log1p(n_chars) / 5, [b.linked for b in flat], [b.text[-1] in ".!?:;" for b in flat],
            n_words / (n_chars + 1) * 4, place / last, place < 3), 1)
        return np.split(x, np.cumsum(sizes)[:-1])


@dataclass
class Model:
    settings: Settings
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, rng: np.random.Generator) -> None:
        h = self.settings.hidden
        for d in "fb":
            self.weights[f"x{d}"] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * h))
            self.weights[f"h{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))
            self.weights[f"c{d}"] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))  # open forget gates
        self.weights["o"] = rng.normal(0, 0.3, 2 * h)
        self.weights["b"] = np.zeros(1)

    def _run(self, x: np.ndarray, live: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """One direction over a batch (B, T, WIDTH); ``live`` marks real steps. Returns (B, T, H)."""
        s, w = self.settings.hidden, self.weights
        n, steps = live.shape
        z_all = x @ w[f"x{d}"] + w[f"c{d}"]
        h, c = np.zeros((n, s)), np.zeros((n, s))
        out = np.zeros((n, steps, s))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_all[:, t] + h @ w[f"h{d}"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * s], -30, 30)))
            i, f, o = gates[:, :s], gates[:, s:2 * s], gates[:, 2 * s:]
            g = np.tanh(z[:, 3 * s:])
            m = live[:, t, None]
            c_new = np.where(m, f * c + i * g, c)
            tc = np.tanh(c_new)
            h_new = np.where(m, o * tc, h)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc))
            h, c = h_new, c_new
            out[:, t] = h
        return out

    def logits(self, x: np.ndarray, live: np.ndarray, keep: dict | None = None) -> np.ndarray:
        parts = [self._run(x, live, d, None if keep is None else keep.setdefault(d, [])) for d in "fb"]
        both = np.concatenate(parts, 2)
        if keep is not None:
            keep["both"] = both
        return both @ self.weights["o"] + self.weights["b"]

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        z = self.logits(x, live, keep)
        p = 1 / (1 + np.exp(-z))
        total = max(live.sum(), 1)
        loss = -(np.log(np.where(y, p, 1 - p) + 1e-12) * live).sum() / total
        dz = (p - y) * live / total
        w, s = self.weights, self.settings.hidden
        grads = {"o": (keep["both"] * dz[..., None]).sum((0, 1)), "b": np.array([dz.sum()])}
        d_both = dz[..., None] * w["o"]
        for k, d in enumerate("fb"):
            d_out = d_both[..., k * s:(k + 1) * s]
            d_z_all = np.zeros((*live.shape, 4 * s))
            dh, dc = np.zeros((len(live), s)), np.zeros((len(live), s))
            grads[f"h{d}"] = np.zeros_like(w[f"h{d}"])
            for t, h, c, i, f, o, g, tc in reversed(keep[d]):
                m = live[:, t, None]
                total_h = dh + d_out[:, t]
                dh_in = np.where(m, total_h, 0)
                dc_in = np.where(m, dc + dh_in * o * (1 - tc ** 2), 0)
                dzt = np.concatenate((dc_in * g * i * (1 - i), dc_in * c * f * (1 - f),
                                      dh_in * tc * o * (1 - o), dc_in * i * (1 - g ** 2)), 1)
                d_z_all[:, t] = dzt
                grads[f"h{d}"] += h.T @ dzt
                dh = np.where(m, dzt @ w[f"h{d}"].T, total_h)
                dc = np.where(m, dc_in * f, dc)
            grads[f"x{d}"] = np.einsum("btw,btz->wz", x, d_z_all, optimize=True)
            grads[f"c{d}"] = d_z_all.sum((0, 1))
        return float(loss), grads

    def label(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length share a batch."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in np.argsort([len(p) for p in pages], kind="stable") if len(pages[i])]
        k = 0
        while k < len(order):
            room = max(1, 6000 // max(1, len(pages[order[min(k + 63, len(order) - 1)]])))
            pick = order[k:k + min(64, room)]
            k += len(pick)
            x, live = padded([pages[i] for i in pick])
            z = self.logits(x, live)
            for row, i in enumerate(pick):
                out[i] = z[row, :len(pages[i])] > 0
        return out


def padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, live = np.zeros((len(pages), steps, WIDTH)), np.zeros((len(pages), steps), bool)
    for i, p in enumerate(pages):
        x[i, :len(p)], live[i, :len(p)] = p, True
    return x, live


def is_main(b: Block) -> bool:
    """The rule that labels training pages: inside article or main, outside of what is set aside."""
    names = set(b.path)
    return bool(names & {"article", "main"}) and not names & ASIDE_TAGS and not any(
        n[2:] in HINTS_ASIDE for n in names if n[1:2] == ".")


# Usual class and id words of parts that hold no main text.
HINTS_ASIDE = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer "
    "form header login masthead menu nav navbar navigation newsletter notice pagination popup promo related reply "
    "share sidebar social sponsor sponsored subscribe toolbar widget".split())


def relaid(texts: list[str], others: list[str], rng: np.random.Generator) -> str:
    """A page that shows ``texts`` as main text in a random layout, among parts made of ``others``."""
    esc = lambda s: escape(s, quote=False)
    hinted = rng.random() < 0.7
    draw = lambda n: [esc(others[i]) for i in rng.integers(0, len(others), n)]
    word = lambda: esc(str(rng.choice(others[rng.integers(0, len(others))].split() or ["x"])))
    pick = lambda *xs: str(xs[rng.integers(0, len(xs))])

    def hint(*words: str) -> str:
        return f' {pick("class", "id")}="{pick(*words)}"' if hinted else ""

    def short(n: int) -> list[str]:
        return [" ".join(word() for _ in range(rng.integers(1, 5))) for _ in range(n)]

    links = lambda n: "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(short(n)))
    menu = f"<{(t := pick('nav', 'div', 'header'))}{hint('menu', 'navbar', 'nav main-nav', 'navigation')}><ul>{links(rng.integers(3, 9))}</ul></{t}>"
    parts_before = [menu]
    if rng.random() < 0.5:
        parts_before.insert(0, f"<header{hint('masthead', 'header')}><h1>{short(1)[0]}</h1><p>{draw(1)[0][:80]}</p></header>")
    if rng.random() < 0.4:
        parts_before.append(f"<div class=\"{pick('ad', 'advert', 'sponsored', 'promo banner')}\">{pick('', '<p>')}{draw(1)[0]}</div>")
    if rng.random() < 0.3:
        parts_before.append(f"<div class=\"{pick('cookie notice', 'cookie-banner', 'consent', 'popup notice')}\"><p>{draw(1)[0][:150]}</p><button>{word()}</button></div>")
    if rng.random() < 0.3:
        parts_before.append(f"<div class=\"{pick('breadcrumbs', 'breadcrumb')}\">{' &gt; '.join(f'<a href=/>{t}</a>' for t in short(3))}</div>")
    after = []
    if rng.random() < 0.5:
        t = pick("aside", "div")
        cls = hint("sidebar", "widget", "related") if t == "aside" else f' class="{pick("sidebar", "related", "widget sidebar")}"'
        after.append(f"<{t}{cls}><h3>{short(1)[0]}</h3><ul>{links(rng.integers(2, 7))}</ul><p>{draw(1)[0]}</p></{t}>")
    if rng.random() < 0.4:
        t = pick("div", "section", "article", "li")
        said = "".join(f'<{t} class="comment"><p>{pick("", "<b>" + word() + "</b> ")}{x}</p></{t}>' for x in draw(rng.integers(1, 5)))
        after.append(f'<{pick("section", "div")} {pick("class", "id")}="comments"><h3>{short(1)[0]}</h3>{said}</div>')
    if rng.random() < 0.3:
        after.append(f"<form{hint('newsletter', 'subscribe', 'login')}><p>{short(1)[0]}</p><label>{word()}</label><input name=q><button>{word()}</button></form>")
    if rng.random() < 0.8:
        t = pick("footer", "footer", "div")
        cls = hint("footer") if t == "footer" else ' class="footer"'
        after.append(f"<{t}{cls}>&copy; {short(1)[0]} &middot; {draw(1)[0]}</{t}>")
    title = f"<h{pick('1', '2')}>{esc(texts[0])}</h1>" if rng.random() < 0.8 else ""
    body = []
    for x in texts[1:]:
        roll = rng.random()
        body.append(f"<h3>{esc(x)[:60]}</h3><p>{esc(x)}</p>" if roll < 0.1 else f"<ul><li>{esc(x)}</li></ul>" if roll < 0.18
                    else f"<blockquote>{esc(x)}</blockquote>" if roll < 0.23 else f"<div>{esc(x)}</div>" if roll < 0.3 else f"<p>{esc(x)}</p>")
    if rng.random() < 0.35:
        inner = pick(f'<div class="{pick("ad", "advert", "promo")}" data-y="0">{draw(1)[0]}</div>',
                     f'<aside data-y="0">{draw(1)[0]}</aside>', f'<div class="share" data-y="0"><a href=/>{word()}</a></div>')
        body.insert(int(rng.integers(0, len(body) + 1)), inner)
    holder = pick("article", "article", "main", "div", "section")
    cls = hint("content", "post", "article body", "entry-content") if holder != "div" else f' class="{pick("content", "post-body", "article text", "entry")}"'
    main = f'<{holder}{cls} data-y="1">{title}{"".join(body)}</{holder}>'
    rest = int(rng.integers(0, 2)) if after else 0
    order = [*parts_before, *after[:rest], main, *after[rest:]]
    return f'<html><head><title>{esc(texts[0])}</title></head><body data-y="0">{"".join(order)}</body></html>'


def training_pages(htmls: Sequence[str], s: Settings) -> list[tuple[list[Block], np.ndarray]]:
    rng = np.random.default_rng(s.seed)
    real = [bs for bs in map(blocks, htmls) if bs]
    marked = [(bs, np.array([is_main(b) for b in bs])) for bs in real]
    pool = [b.text for bs in real for b in bs] or list(SENTENCES)
    own = [[b.text for b, y in zip(bs, ys) if y] for bs, ys in marked]
    own = [t for t in own if t] or [list(SENTENCES)] * 20
    out = [(bs, ys) for bs, ys in marked if ys.any()]
    for texts in own:
        for _ in range(s.variants):
            bs = blocks(relaid(texts[:30], pool, rng))
            out.append((bs, np.array([b.label == "1" for b in bs])))
    return out


def train(htmls: Sequence[str], s: Settings = Settings()) -> Model:
    rng = np.random.default_rng(s.seed + 1)
    model, features = Model(s), Features()
    model.start(rng)
    marked = training_pages(htmls, s)
    pages = list(zip(features.of([bs for bs, _ in marked]), [ys for _, ys in marked]))
    mean = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    step = 0
    for epoch in range(s.epochs):
        order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][0]) // 8)
        cuts = [order[k:k + s.batch] for k in range(0, len(order), s.batch)]
        rng.shuffle(cuts)
        for cut in cuts:
            x, live = padded([pages[i][0] for i in cut])
            y = np.zeros(live.shape, bool)
            for row, i in enumerate(cut):
                y[row, :len(pages[i][1])] = pages[i][1]
            _, grads = model.gradients(x, live, y)
            norm = np.sqrt(sum((g ** 2).sum() for g in grads.values()))
            step += 1
            for k, g in grads.items():  # Adam, clipped
                g = g * min(1.0, 5.0 / (norm + 1e-12))
                m1, m2 = mean[k]
                m1 *= 0.9
                m1 += 0.1 * g
                m2 *= 0.999
                m2 += 0.001 * g ** 2
                rate = s.rate * (1 - epoch / s.epochs) + 0.001
                model.weights[k] -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(pages: DataFrame, s: Settings = Settings()) -> Model:
    """Train on the sampled pages, brought to the driver (at most ``max_pages``)."""
    # Only ids travel through the ordering; the texts of the chosen few are then filtered.
    ids = pages.where("page_id is not null and html is not null").select("page_id").orderBy(
        F.xxhash64("page_id", F.lit(s.seed)), "page_id").limit(s.max_pages).distinct()
    rows = pages.select("page_id", "html").join(F.broadcast(ids), "page_id").toPandas()
    rows = rows.dropna().sort_values(["page_id", "html"]).drop_duplicates("page_id")
    return train(rows["html"].tolist(), s)


def main_texts(model: Model, htmls: Sequence[str | None], features: Features) -> list[str]:
    cut = [blocks(h) for h in htmls]
    labels = model.label(features.of(cut))
    return ["\n\n".join(b.text for b, y in zip(bs, ys) if y) for bs, ys in zip(cut, labels)]


def extract_column(model: Model, pages: DataFrame, html: str = "html") -> Column:
    """The main text of each whole page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StringType())
    def extract(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for col in frames:
            yield pd.Series([t for i in range(0, len(col), PAGES) for t in main_texts(sent.value, col.iloc[i:i + PAGES].tolist(), features)], dtype=object)

    return extract(F.col(html))


def extracted(pages: DataFrame, s: Settings = Settings(), html: str = "html", into: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` with the main text added as ``into``."""
    return pages.withColumn(into, extract_column(fit(pages, s), pages, html))
