"""Language identification by a byte convolutional network, in numpy.

Texts become UTF-8 bytes in windows of ``window`` bytes (the whole text, the last
window padded with zeros). Every byte has a small vector; filters of several
widths run over a window, ReLU and max pooling keep each filter's best match, and
a softmax layer gives the languages' probabilities. A document's score is its
windows' mean log-probability, each weighted by its bytes, made into
probabilities again.

Training (Adam, on the driver) uses at most ``per_language`` labelled texts of each
language, those with the smallest hash of the text, and at most ``train_bytes``
of each: a bounded sample; the bounds are parameters. Every non-null label is
learned, however many there are, so the sample and the time to train grow with
their number. Prediction reads whole texts.

Null text and text without a letter give ``und`` with score 0. So does an operator
that was trained on no rows. Repeated rows are predicted alike; of equal
probabilities the first language in sorted order is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hourcast.llm.common import pick, prepare
from hourcast.sinks.util import materialize

UND = "und"


@dataclass
class ByteCNN:
    """Byte vectors, filters by width, and the softmax layer."""

    languages: list[str]
    window: int = 256
    embed: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (2, 3, 4)
    seed: int = 7
    params: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.params:
            r = np.random.default_rng(self.seed)
            self.params = {"E": r.normal(0, 0.5, (256, self.embed)).astype(np.float32)}
            for w in self.widths:
                scale = 1 / np.sqrt(w * self.embed)
                self.params[f"W{w}"] = r.normal(0, scale, (w, self.embed, self.filters)).astype(np.float32)
                self.params[f"b{w}"] = np.zeros(self.filters, np.float32)
            n = self.filters * len(self.widths)
            self.params["U"] = r.normal(0, 1 / np.sqrt(n), (n, len(self.languages))).astype(np.float32)
            self.params["c"] = np.zeros(len(self.languages), np.float32)

    # ---- training -------------------------------------------------------
    def _forward(self, x: np.ndarray):
        p, cache, pooled = self.params, [], []
        e = p["E"][x]
        for w in self.widths:
            t = x.shape[1] - w + 1
            z = sum(e[:, o:o + t] @ p[f"W{w}"][o] for o in range(w)) + p[f"b{w}"]
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0]
            cache.append((best, top > 0))
            pooled.append(np.maximum(top, 0))
        h = np.concatenate(pooled, axis=1)
        return e, cache, h, softmax(h @ p["U"] + p["c"])

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        e, cache, h, prob = self._forward(x)
        d = prob.copy()
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"U": h.T @ d, "c": d.sum(axis=0), "E": np.zeros_like(p["E"])}
        dh, rows = d @ p["U"].T, np.arange(len(x))[:, None]
        for k, w in enumerate(self.widths):
            best, on = cache[k]
            dz = dh[:, k * self.filters:(k + 1) * self.filters] * on
            g[f"b{w}"], g[f"W{w}"] = dz.sum(axis=0), np.zeros_like(p[f"W{w}"])
            for o in range(w):  # only the best place of each filter has a gradient
                g[f"W{w}"][o] = np.einsum("nfe,nf->ef", e[rows, best + o], dz)
                np.add.at(g["E"], x[rows, best + o], dz[:, :, None] * p[f"W{w}"][o].T[None])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.005) -> "ByteCNN":
        r = np.random.default_rng(self.seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        s = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                step += 1
                rows = order[i:i + batch]
                for k, g in self._gradients(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.params[k] = (self.params[k] - rate * (m[k] / (1 - 0.9 ** step))
                                      / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    # ---- prediction -----------------------------------------------------
    def tables(self) -> list[list[np.ndarray]]:
        """For each width, the filters' answers by byte pair (and single byte): the convolution as look-ups."""
        out, e = [], self.params["E"]
        for w in self.widths:
            one = [e @ self.params[f"W{w}"][o] for o in range(w)]
            one[0] = one[0] + self.params[f"b{w}"]
            parts = [(one[o][:, None, :] + one[o + 1][None, :, :]).reshape(65536, self.filters) for o in range(0, w - 1, 2)]
            out.append(parts + ([one[w - 1]] if w % 2 else []))
        return out

    def log_probabilities(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """For rows of windows (n, window)."""
        pair = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
        pooled = []
        for w, parts in zip(self.widths, tables, strict=True):
            t = x.shape[1] - w + 1
            z = None
            for k, part in enumerate(parts):
                at = pair[:, 2 * k:2 * k + t] if len(part) == 65536 else x[:, w - 1:w - 1 + t]
                got = part.take(at, axis=0, mode="clip")
                z = got if z is None else np.add(z, got, out=z)
            while z.shape[1] > 1:  # halving keeps the inner loops long
                half = z.shape[1] // 2
                z = np.maximum(z[:, :half], z[:, -half:]) if z.shape[1] % 2 == 0 else np.concatenate(
                    [np.maximum(z[:, :half], z[:, half:-1]), z[:, -1:]], axis=1)
            pooled.append(np.maximum(z[:, 0], 0))
        return np.log(softmax(np.concatenate(pooled, axis=1) @ self.params["U"] + self.params["c"]) + 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


#: Labels up to which their bounds (a name and a number each) are sent to all tasks; beyond, rows are shuffled to them.
BROADCAST_LABELS = 4096


def windows_of(data: bytes, window: int) -> np.ndarray:
    """The bytes in rows of ``window``; the last is padded with zeros."""
    n = -(-max(1, len(data)) // window)
    x = np.zeros(n * window, dtype=np.uint8)
    x[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    return x.reshape(n, window)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
          per_language: int = 300, train_bytes: int = 2048, **model) -> ByteCNN | None:
    """Fit on at most ``per_language`` rows of each of ``df``'s languages; None if there are none.

    Only texts and languages enter, not the ids. The sample is drawn by the texts' hashes, each once,
    so copies don't crowd it. Hashes are even, so those below a bound taken from each language's
    count are about four times as many as wanted, whatever the input's size; of
    these the smallest are drawn, and their texts are read.
    """
    d = pick(df, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    d = d.withColumn("h", F.xxhash64("text"))
    hashes = materialize(d.select("lang", "h").distinct(), "text_hashes")
    counts = {r["lang"]: r["count"] for r in hashes.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return None

    def below(rows: DataFrame, bounds: dict[str, int]) -> DataFrame:
        """Rows whose hash is at most their language's bound; joined, so that any number of languages can be asked for."""
        at = df.sparkSession.createDataFrame(list(bounds.items()), "lang string, bound long")
        return rows.join(F.broadcast(at) if len(bounds) <= BROADCAST_LABELS else at, "lang").where("h <= bound")

    rough = {lang: min((1 << 63) - 1, (4 * per_language << 64) // n - (1 << 63)) for lang, n in counts.items()}
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = below(hashes, rough).withColumn("n", place).where(F.col("n") <= per_language)
    limits = {r["lang"]: r["m"] for r in drawn.groupBy("lang").agg(F.max("h").alias("m")).collect()}
    if not limits:
        return None
    rows = (below(d, limits).withColumn("text", F.substring("text", 1, train_bytes)).dropDuplicates(["lang", "h"])
            .select("lang", "text", "h").collect())  # per_language rows a language, train_bytes characters each
    languages = sorted(limits)
    place_of = {lang: i for i, lang in enumerate(languages)}
    net = ByteCNN(languages, **model)
    x, y = [], []
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        data = r["text"].encode("utf-8", "surrogatepass")[:train_bytes]
        if has_letter(r["text"]):
            w = windows_of(data, net.window)
            x.append(w)
            y += [place_of[r["lang"]]] * len(w)
            short = windows_of(data[: max(8, len(data) % 97)], net.window)  # short texts must be told apart too
            x.append(short)
            y.append(place_of[r["lang"]])
    return net.fit(np.concatenate(x), np.array(y)) if x else None


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(df: DataFrame, net: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns as ``c_<name>``, lang_pred, score) for every row."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, text=text_col, **{f"c_{c}": c for c in carry})
    schema = d.schema
    out_fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in it:
            lang, score = _predict(batch.column("text"), net, tables)
            keep = [i for i, n in enumerate(batch.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*(batch.schema.names[i] for i in keep), "lang_pred", "score"])

    return d.mapInArrow(run, f"{out_fields}, lang_pred string, score double")


#: Windows that go through the network at once.
STEP = 32


def _predict(texts: pa.Array, net: ByteCNN | None, tables) -> tuple[list[str], list[float]]:
    texts = texts.to_pylist()
    lang, score = [UND] * len(texts), [0.0] * len(texts)
    at = [i for i, t in enumerate(texts) if net is not None and has_letter(t)]
    if not at:
        return lang, score
    data = [texts[i].encode("utf-8", "surrogatepass") for i in at]
    window = net.window
    per_doc = np.array([-(-len(b) // window) for b in data])
    x = np.concatenate([windows_of(b, window) for b in data])
    logs = np.concatenate([net.log_probabilities(x[i:i + STEP], tables) for i in range(0, len(x), STEP)])
    weight = np.full(len(x), window, dtype=np.float64)
    first = np.concatenate(([0], np.cumsum(per_doc)[:-1]))
    weight[first + per_doc - 1] = [(len(b) - 1) % window + 1 for b in data]
    mean = np.add.reduceat(logs * weight[:, None], first, axis=0) / np.add.reduceat(weight, first)[:, None]
    prob = softmax(mean)
    best = prob.argmax(axis=1)
    for i, k, p in zip(at, best, prob, strict=True):
        lang[i], score[i] = net.languages[k], float(min(1.0, p[k]))
    return lang, score
