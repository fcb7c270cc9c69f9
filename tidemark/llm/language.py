"""Language ID: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased, every ASCII byte that is no letter becomes a space, and its subwords are the runs of two to four
bytes that hold a space at an end at most, so that a word's ends are marked. Each is hashed to one of ``BUCKETS`` embeddings; the
text is their average, and a linear softmax gives the languages. Both layers are trained by stochastic gradient descent in
numpy, on ``SAMPLE`` labelled rows at most, dealt evenly to the languages: of each, the rows whose hashes of id and text
are least. Rows that agree in both count once, so neither missing nor repeated ids let more in. Executors turn them into
sparse counts, so the driver holds ``SAMPLE`` rows of ``BUCKETS`` numbers at most, however long a text is.

A quarter of the sample is kept from training to calibrate. A temperature makes the softmax a probability. The softmax
always prefers some language, so rejection asks another question: how typical the text's subwords are of the language that
was chosen, by the mean logarithm of their frequencies there. That mean scatters with a variance a + b/n around its median,
n being the subwords of a text, so it is measured in such deviations; a text is rejected that falls below all but
``FALSE_REJECTS`` of the calibrating rows, and ``MILDEST`` at least. Texts in a language that was not learned fall far below.

Both tables are linear in the counts, so prediction needs a row of numbers per bucket: every task gets
that table (twice ``BUCKETS`` by ``LANGUAGES`` numbers at most) and adds up whole texts. Nothing is shuffled.

Null texts and texts without a letter are ``und`` with score 0 and rejected; so is everything if there is no labelled
row. A null id is in the training part. Beyond ``LANGUAGES`` values of lang, the most frequent are learned. Rows that
repeat an id get a row each; ids are cast to long in the result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import table

BUCKETS = 1 << 14
DIMENSIONS = 16
LANGUAGES = 256
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 3200
CALIBRATE_SHARE = 0.25
FALSE_REJECTS = 0.005
#: A few alike rows must not make every other text untypical: the least a and b, and the least deviations to reject at.
LEAST_SPREAD = (4e-4, 5.0)
MILDEST = -8.0
#: Share of a language's frequencies that is spread over all buckets, seen or not.
UNSEEN = 0.01
#: Doubt left in the calibration rows' labels, without which a perfect fit would have no finite temperature.
DOUBT = 0.002
UNKNOWN = "und"
EPOCHS = 8
BATCH = 16
RATE = 30.0

_FOLD = np.array([c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)
_ASCII_LETTER = re.compile("[A-Za-z]")
_LONGEST = 4


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def folded(text: str) -> np.ndarray:
    """The bytes subwords are taken from, with a space at both ends."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    return _FOLD[raw]


def _buckets(raw: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the subword of ``n`` bytes at each place, and whether there is one."""
    count = len(raw) - n + 1
    if count <= 0:
        return np.empty(0, np.uint32), np.empty(0, bool)
    h = np.full(count, n, np.uint32)
    for j in range(n):
        h *= np.uint32(0x01000193)
        h ^= raw[j : j + count]
    h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    h >>= np.uint32(32 - BUCKETS.bit_length() + 1)
    space = raw == 32
    if n == 2:
        is_one = ~(space[:count] & space[1 : 1 + count])
    else:
        is_one = ~space[1 : 1 + count]
        for j in range(2, n - 1):
            is_one &= ~space[j : j + count]
    return h, is_one


def counts(text: str) -> np.ndarray:
    """How often each bucket occurs, over the whole text in pieces."""
    raw, out = folded(text), np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw), 1 << 20):
        for n in range(2, _LONGEST + 1):
            h, is_one = _buckets(raw[at : at + (1 << 20) + n - 1], n)
            out += np.bincount(h[is_one], minlength=BUCKETS)
    return out


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # per bucket: a score for each language, then its logarithm of frequency in each
    bias: np.ndarray
    temperature: float = 1.0
    usual: np.ndarray | None = None  # median over texts of the mean logarithm, by language
    spread: tuple[float, float] = (1.0, 1.0)  # a and b
    threshold: float = 0.0

    def means(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The mean of both tables over each text's subwords, and their number.

        Texts are added up together as far as memory allows, and long ones in pieces.
        """
        k = self.scores.shape[1]
        room = max(1 << 14, (1 << 23) // k)
        sums, total = np.zeros((len(texts), k)), np.zeros(len(texts))
        waiting: list[np.ndarray] = []
        first = 0
        for i, text in enumerate(texts):
            raw = folded(text)
            if waiting and sum(map(len, waiting)) + len(raw) > room:
                self._add(waiting, first, sums, total)
                waiting = []
            if not waiting:
                first = i
            if len(raw) > room:
                for at in range(0, len(raw), room):
                    # Pieces overlap by what the longest subword needs; each piece counts its own starts.
                    self._add([raw[at : at + room + _LONGEST - 1]], i, sums, total, starts=room)
            else:
                waiting.append(raw)
        if waiting:
            self._add(waiting, first, sums, total)
        return sums / np.maximum(total, 1)[:, None], total

    def logits(self, texts: list[str]) -> np.ndarray:
        return self.means(texts)[0][:, : len(self.languages)] + self.bias

    def typical(self, mean: np.ndarray, total: np.ndarray, language: np.ndarray) -> np.ndarray:
        """By how many deviations the mean logarithms lie above what is usual for texts of ``language``."""
        own = mean[np.arange(len(language)), len(self.languages) + language]
        return (own - self.usual[language]) / np.sqrt(self.spread[0] + self.spread[1] / np.maximum(total, 1))

    def _add(self, raws, first, sums, total, starts=None) -> None:
        joined = np.concatenate(raws)
        ends = np.cumsum([len(r) for r in raws])
        begins = np.concatenate(([0], ends[:-1]))
        rows = slice(first, first + len(raws))
        for n in range(2, _LONGEST + 1):
            h, is_one = _buckets(joined, n)
            if starts is not None:
                h, is_one = h[:starts], is_one[:starts]
            if not len(h):
                continue
            # Two texts meet as two spaces, which no subword spans.
            at = np.flatnonzero(is_one)
            if not len(at):
                continue
            bounds = np.searchsorted(at, begins)
            own = np.diff(np.append(bounds, len(at)))
            some = own > 0
            values = self.scores[h[at]]
            got = np.zeros((len(raws), values.shape[1]))
            got[some] = np.add.reduceat(values, bounds[some], axis=0)
            sums[rows] += got
            total[rows] += own

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score, and whether the text is rejected."""
        named, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if known:
            mean, total = self.means([texts[i] for i in known])
            p = softmax((mean[:, : len(self.languages)] + self.bias) / self.temperature)
            best = p.argmax(axis=1)
            out = self.typical(mean, total, best) < self.threshold
            for row, i in enumerate(known):
                named[i], score[i], rejected[i] = self.languages[best[row]], float(p[row, best[row]]), bool(out[row])
        return named, score, rejected


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, bool]]) -> Model:
    """Rows are language, buckets, counts, and whether the row calibrates instead of trains."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 2), np.float32), np.zeros(1))
    number = {name: i for i, name in enumerate(languages)}
    k = len(languages)

    def dense(some: list) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(some), BUCKETS), np.float32)
        for i, (_, where, count, _) in enumerate(some):
            x[i, where] = count / max(1, count.sum())
        return x, np.array([number[r[0]] for r in some])

    train = [r for r in rows if not r[3]] or rows
    held = [r for r in rows if r[3]] or rows
    draw = np.random.default_rng(5)
    embed = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    linear, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(train))
        for at in range(0, len(train), BATCH):
            x, y = dense([train[i] for i in order[at : at + BATCH]])
            h = x @ embed
            p = softmax(h @ linear + bias)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            rate = RATE * (1 - done / steps)
            into = p @ linear.T
            linear -= rate * (h.T @ p)
            bias -= 0.01 * rate * p.sum(axis=0)
            embed -= rate * (x.T @ into)
            done += 1
    frequency = np.zeros((BUCKETS, k))
    for at in range(0, len(train), 64):
        x, y = dense(train[at : at + 64])
        np.add.at(frequency.T, y, x)
    frequency /= np.maximum(frequency.sum(axis=0), 1e-9)
    usual = np.log((1 - UNSEEN) * frequency + UNSEEN / BUCKETS)
    model = Model(languages, np.hstack((embed @ linear, usual)).astype(np.float32), bias.astype(np.float64))
    means, truth, totals = [], [], []
    for at in range(0, len(held), 64):
        x, y = dense(held[at : at + 64])
        means.append(x @ model.scores)
        truth.append(y)
        totals.append([r[2].sum() for r in held[at : at + 64]])
    return calibrate(model, np.concatenate(means), np.concatenate(truth), np.concatenate(totals))


def calibrate(model: Model, mean: np.ndarray, truth: np.ndarray, total: np.ndarray) -> Model:
    k = len(model.languages)
    logits = mean[:, :k] + model.bias
    wanted = np.full(logits.shape, DOUBT / k)
    wanted[np.arange(len(truth)), truth] += 1 - DOUBT

    def loss(t: float) -> float:
        return float(-(wanted * np.log(np.maximum(softmax(logits / t), 1e-300))).sum(axis=1).mean())

    model.temperature = float(min(np.geomspace(0.02, 20, 61), key=loss))
    own = mean[np.arange(len(truth)), k + truth]
    # A language without a calibrating row is as usual as the others.
    model.usual = np.array([np.median(own[truth == i] if (truth == i).any() else own) for i in range(k)])
    off, long_text = own - model.usual[truth], total >= np.median(total)
    # Medians of absolute and squared normal deviations, so that a few odd rows do not widen them.
    a = (1.4826 * np.median(np.abs(off[long_text]))) ** 2
    b = np.median(off[~long_text] ** 2 * total[~long_text]) / 0.455 if not long_text.all() else 1.0
    model.spread = (max(float(a), LEAST_SPREAD[0]), max(float(b), LEAST_SPREAD[1]))
    reached = np.sort(model.typical(mean, total, truth))
    model.threshold = min(float(reached[int(FALSE_REJECTS * len(reached))]), MILDEST)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that have a lang and are not held out."""
    labelled = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("hash"))
    sizes = (
        labelled.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("hash").alias("different"))
        .orderBy(F.desc("rows"), "lang").limit(LANGUAGES).collect()
    )
    if not sizes:
        return fit([])
    each = max(4, sample // len(sizes))
    # Room for the error of the estimate; what is too many goes again below.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, 1.5 * (each + 20) / r["different"]))])
    place = F.pmod("hash", F.lit(1 << 40)) / float(1 << 40)
    few = labelled.where(place < share[F.col("lang")]).groupBy("lang", "hash").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, often = [], []
            for text in batch.column("text").to_pylist():
                c = counts(text)
                own = np.flatnonzero(c)
                where.append(own.astype(np.uint16).tobytes())
                often.append(c[own].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"), batch.column("hash"), pa.array(where, pa.binary()), pa.array(often, pa.binary()),
                    batch.column("calibrates"),
                ],
                names=["lang", "hash", "buckets", "counts", "calibrates"],
            )

    calibrates = F.pmod(F.xxhash64("hash", F.lit("calibrate")), F.lit(1000)) < F.lit(int(1000 * CALIBRATE_SHARE))
    rows = few.select("lang", "hash", "text", calibrates.alias("calibrates")).mapInArrow(
        count, "lang string, hash long, buckets binary, counts binary, calibrates boolean"
    )
    by_hash = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1 << 40)), "hash")
    least = rows.withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= each)
    # Numbers stay packed on the driver; a list of them would take ten times the room.
    return fit([
        (r.lang, np.frombuffer(r.buckets, np.uint16), np.frombuffer(r["counts"], np.uint32), r.calibrates)
        for r in least.orderBy("lang", "turn").toLocalIterator()
    ])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            named, score, out = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, lang_pred string, score double, rejected boolean")


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, whole; they pass the workers once and are not joined again."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            _, _, rejected = model.predict(batch.column(text_col).to_pylist())
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
