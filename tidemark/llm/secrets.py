"""Secret scans: base patterns, and two character Markov models compared by log-likelihood ratio.

Both models are of first order over the 64 characters of ``[A-Za-z0-9+/_-]`` (with ``=`` folded into ``/``) and a start
state. Transitions back off to the frequency of single characters, which is smoothed by one. One is trained on random strings, one on ordinary identifiers. The labelled samples
are the documents' own: values that a base pattern found are random strings; other identifiers of eight or more characters
are ordinary; about ``SAMPLE`` documents with each are taken, by a hash of the id and the text. Tasks send only transition
counts, which Spark adds up, so the driver gets two tables of 65 by 64 numbers whatever the texts hold.

Texts are read once. What that pass finds (base spans, candidates, samples) is written, and training and judging
read only that.

Every run of ``LEAST`` or more such characters is a candidate, less what base spans cover of it. It is reported as
``markov`` when the random model explains it better by ``MARGIN`` bits a character; nothing else decides.

Spans are in code points with the end exclusive, ordered by start, then kind as listed. Null texts count as empty. Rows that
repeat an id get a row each; ids are cast to long. Without labelled samples the smoothed models are equal and nothing is
added. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import scratch, table

#: Fixed by the contract, in its order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "markov")

LEAST = 16
MARGIN = 1.0
#: Weight of single characters against the transitions seen.
BACK_OFF = 4.0
SAMPLE = 4000
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}")
_STATES = 65
_CODE = np.zeros(256, np.uint8)
for _i, _c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"):
    _CODE[_c] = min(_i, 63)
_CODE[ord("=")] = _CODE[ord("/")]

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; those that fail their condition are dropped afterwards."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    # For these two the length in the pattern is the same as dropping short matches: a run is matched whole or not.
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of all strings (from, to as one number; a string starts in the last state), and where each begins."""
    joined = _CODE[np.frombuffer("".join(strings).encode("ascii"), np.uint8)].astype(np.int64)
    begins = np.concatenate(([0], np.cumsum([len(s) for s in strings])[:-1])).astype(np.int64)
    before = np.empty_like(joined)
    before[1:] = joined[:-1]
    before[begins] = _STATES - 1
    return before * 64 + joined, begins


def transition_counts(strings: list[str]) -> np.ndarray:
    strings = [s for s in strings if s]
    if not strings:
        return np.zeros(_STATES * 64, np.int64)
    return np.bincount(_codes(strings)[0], minlength=_STATES * 64)


def log_ratio(random_counts: np.ndarray, ordinary_counts: np.ndarray) -> np.ndarray:
    """Bits by which each transition favours the random model."""
    logs = []
    for counts in (random_counts, ordinary_counts):
        rows = counts.reshape(_STATES, 64).astype(float)
        alone = rows.sum(axis=0) + 1
        rows += BACK_OFF * alone / alone.sum()
        logs.append(np.log2(rows / rows.sum(axis=1, keepdims=True)))
    return (logs[0] - logs[1]).ravel()


def _outside(text: str, pattern: re.Pattern, spans: list[Span]) -> list[tuple[int, int]]:
    """Matches that no span touches."""
    found = [m.span() for m in pattern.finditer(text)]
    return [(a, b) for a, b in found if all(b <= s or e <= a for s, _, e in spans)] if spans else found


def _uncovered(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Runs of ``LEAST`` characters or more, cut where base spans begin and end."""
    out = []
    for m in _RUN.finditer(text):
        at, end = m.span()
        for s, _, e in spans:  # by their start
            if s < end and at < e:
                out.append((at, s))
                at = max(at, e)
        out.append((at, end))
    return [(a, b) for a, b in out if b - a >= LEAST]


def _values(text: str, spans: list[Span]) -> list[str]:
    """What the base spans hold of a secret, in the models' alphabet."""
    values = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    values += [text[s:e] for s, kind, e in spans if kind]
    return [v for v in (re.sub(r"[^A-Za-z0-9+/_=-]", "", v) for v in values) if v]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_PLACES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]))
_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("run", pa.string())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))


def search(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The one pass over the texts: base spans, their values, candidates, and a sample's ordinary identifiers."""
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        (place < F.lit(min(1.0, sample / max(1, docs.count())))).alias("sampled"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, values, runs, ordinary = [], [], [], []
            for text, sampled in zip(batch.column("text").to_pylist(), batch.column("sampled").to_pylist()):
                text = text or ""
                spans = base_spans(text)
                base.append([{"start": s, "end": e, "kind": k} for s, k, e in spans])
                values.append(_values(text, spans) if spans else [])
                runs.append([{"start": a, "end": b, "run": text[a:b]} for a, b in _uncovered(text, spans)])
                ordinary.append([text[a:b] for a, b in _outside(text, _ORDINARY, spans)] if sampled else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, _PLACES), pa.array(values, pa.list_(pa.string())),
                 pa.array(runs, _RUNS), pa.array(ordinary, pa.list_(pa.string()))],
                names=["doc_id", "base", "values", "runs", "ordinary"],
            )

    return scratch(
        rows.mapInArrow(
            scan,
            "doc_id long, base array<struct<start:int,end:int,kind:int>>, values array<string>, "
            "runs array<struct<start:int,end:int,run:string>>, ordinary array<string>",
        ),
        "secrets",
    )


def labelled(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """value, random: the labelled samples that ``search`` has met, from about ``sample`` documents of either label."""
    some = found.where(F.size("values") > 0)
    place = F.pmod(F.xxhash64("doc_id", "values", F.lit("values")), F.lit(1 << 30)) / float(1 << 30)
    some = some.where(place < F.lit(min(1.0, sample / max(1, some.count()))))
    return some.select(F.explode("values").alias("value"), F.lit(True).alias("random")).unionByName(
        found.where(F.size("ordinary") > 0).select(F.explode("ordinary").alias("value"), F.lit(False).alias("random"))
    )


def train(samples: DataFrame) -> np.ndarray:
    """The log ratio table from rows of value and random."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _STATES * 64), np.int64)
        for batch in batches:
            strings: tuple[list, list] = ([], [])
            for value, is_random in zip(batch.column("value").to_pylist(), batch.column("random").to_pylist()):
                strings[0 if is_random else 1].append(value)
            for row, own in zip(sums, strings):
                row += transition_counts(own)
        yield pa.RecordBatch.from_arrays([pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))], names=["sums"])

    parts = samples.mapInArrow(count, "sums array<long>").select(F.posexplode("sums").alias("at", "n"))
    total = np.zeros(2 * _STATES * 64, np.int64)
    for r in parts.where("n > 0").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r["at"]] = r["n"]
    return log_ratio(total[: _STATES * 64], total[_STATES * 64 :])


def random_looking(runs: list[str], ratio: np.ndarray, margin: float = MARGIN) -> np.ndarray:
    """Which of the strings the random model explains better by ``margin`` bits a character."""
    if not runs:
        return np.empty(0, bool)
    moves, begins = _codes(runs)
    return np.add.reduceat(ratio[moves], begins) / np.array([len(r) for r in runs]) >= margin


def judged(found: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, spans (start, end, kind, base), base_sha256, written for every row."""
    sent = found.sparkSession.sparkContext.broadcast(ratio)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, runs = batch.column("base").to_pylist(), batch.column("runs").to_pylist()
            chosen = iter(random_looking([r["run"] for own in runs for r in own], sent.value).tolist())
            every, digests = [], []
            for own, more in zip(bases, runs):
                spans = [(s["start"], s["kind"], s["end"]) for s in own]
                digests.append(hashlib.sha256(written(spans).encode()).hexdigest())
                every.append(sorted(spans + [(r["start"], 3, r["end"]) for r in more if next(chosen)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(
                        [[{"start": s, "end": e, "kind": KINDS[k], "base": k < 3} for s, k, e in own] for own in every],
                        _SPANS,
                    ),
                    pa.array(digests, pa.string()),
                    pa.array([written(x) for x in every], pa.string()),
                ],
                names=["doc_id", "spans", "base_sha256", "written"],
            )

    return found.select("doc_id", "base", "runs").mapInArrow(
        judge,
        "doc_id long, spans array<struct<start:int,end:int,kind:string,base:boolean>>, base_sha256 string, written string",
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = search(table(spark, sf_dir, "documents"))
    found = judged(met, train(labelled(met)))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        "base_sha256", F.col("written").alias("spans"), n("markov").alias("n_markov"),
    )
