"""Subject areas of documents: weighted terms found by a multi-pattern automaton in what a reader sees.

A document's share of a subject is that subject's part of the weight of all terms found: curated weight times rarity
over all documents.  Terms that stand for several subjects, or are used everywhere, count only beside others of a
subject.  Two thresholds, of the share and of the density for the length, are calibrated on labelled documents.
"""

from __future__ import annotations

import logging
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.lexicon import COMMON, TERMS, WEIGHTS
from sightline.session import settled

log = logging.getLogger(__name__)


ACCENTS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "r": "\u030a"}
ACCENT = re.compile(r"\\(?:(['`^\"~=.])\s*|([cvur])(?:\s+|(?=\{)))(?:\{\\?([A-Za-z])\}|\\?([A-Za-z])(?![A-Za-z]{2,}\{))")
NOTE = re.compile(r"(?m)(?<!\\)((?:\\\\)*)%.*")
HIDDEN = re.compile(r"\\begin\{comment\}.*?(?:\\end\{comment\}|\Z)|\\iffalse\b.*?(?:\\fi\b|\Z)", re.S)
BODY = r"\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}"
DEFINED = re.compile(r"\\(?:(?:re)?newcommand\*?|providecommand\*?|DeclareMathOperator\*?)\s*\{?\\([A-Za-z]+)\}?\s*(\[\d\](?:\[[^\]]*\])?)?\s*" + BODY + r"|\\[gex]?def\s*\\([A-Za-z]+)\s*((?:#\d)*)" + BODY, re.S)
UNREAD = re.compile(
    r"\\begin\{(thebibliography|equation\*?|align\*?|eqnarray\*?|gather\*?|multline\*?|math|displaymath|filecontents\*?)\}.*?(?:\\end\{\1\}|\Z)"
    r"|\$\$.*?\$\$|\$[^$]*\$|\\\[.*?\\\]|\\\(.*?\\\)"
    r"|\\(?:cite[a-z]*|nocite|ref|eqref|pageref|autoref|cref|label|bibliography|bibliographystyle|input|include|subfile|includegraphics|usepackage|documentclass|author|date|url|href|bibitem)(?![A-Za-z])\*?\s*(?:\[[^\]]*\])*\s*(?:" + BODY + ")?",
    re.S,
)
COMMAND = re.compile(r"\\(?:begin|end)\{[a-zA-Z*]+\}(?:\{[^{}]*\})?|\\[a-zA-Z]+\*?")
WORDLIKE = re.compile(r"[^\w-]+|_")
MARKS = re.compile("[\u0300-\u036f]+")  # combining accents


def readable(text: str | None) -> str:
    """What a reader sees, as words in lower case with single spaces between.

    Left out: comments, switched-off parts, everything before the document but its title, bibliographies and
    the marks of citations, formulas, and what follows the document's end. The author's own macros are replaced
    by what they stand for.
    """
    text = unicodedata.normalize("NFKC", (text or "").replace("\r\n", "\n").replace("\r", "\n"))
    text = HIDDEN.sub(" ", NOTE.sub(r"\1", text))
    if "\\" in text:
        text = text.replace("\\-", "")
        text = ACCENT.sub(lambda m: (m[3] or m[4]) + ACCENTS[m[1] or m[2]], text)
        macros = {m[1] or m[4]: (m[3] if m[1] else m[6]) for m in DEFINED.finditer(text) if not (m[2] or m[5])}
        text = DEFINED.sub(" ", text)
        before, begun, after = text.partition("\\begin{document}")
        if begun:
            titles = re.findall(r"\\title\*?\s*" + BODY, before, re.S)
            text = " ".join(titles) + "\n" + after.partition("\\end{document}")[0]
        if macros:
            use = re.compile(r"\\(" + "|".join(sorted(map(re.escape, macros), key=len, reverse=True)) + r")(?![A-Za-z])(?:\{\}|\\ )?")
            for _ in range(3):  # macros within macros
                text, n = use.subn(lambda m: macros[m[1]], text)
                if not n:
                    break
        text = COMMAND.sub(" ", UNREAD.sub(" ", text))
    text = unicodedata.normalize("NFC", text.replace("\xad", "").replace("\u200b", "")).lower()
    return WORDLIKE.sub(" ", text).strip()


def folded(text: str) -> str:
    """Without accents, hyphens as blanks: the form in which terms are found."""
    plain = text.lower().replace("-", " ")
    if not plain.isascii():
        plain = MARKS.sub("", unicodedata.normalize("NFD", plain.replace("ß", "ss")))
    return " ".join(plain.split())


def forms(term: str) -> set[str]:
    """A term and its inflected forms, by the plurals of the three languages."""
    found = {term, term + "s", term + "es"}
    if len(term) >= 5:
        found |= {term + "n", term + "en", term + "e"}
    if term.endswith("y"):
        found.add(term[:-1] + "ies")
    if term.endswith("z"):
        found.add(term[:-1] + "ces")
    return found


@dataclass(frozen=True)
class Lexicon:
    """Terms, their curated weight for each subject (terms x subjects, 0: none), and which count only beside others."""

    subjects: tuple[str, ...]
    terms: tuple[str, ...]
    weight: np.ndarray
    beside: np.ndarray

    @property
    def without_terms(self) -> list[str]:
        return [s for s, n in zip(self.subjects, (self.weight > 0).sum(0)) if not n]


@lru_cache(maxsize=4)
def lexicon(areas: tuple[tuple[str, str | None], ...] = ()) -> Lexicon:
    """The curated terms of all subjects that have some, and for the given areas (subject, description) their names and
    the words that only one of the descriptions has."""
    subjects = tuple(sorted({*TERMS, *(s for s, _ in areas)}))
    rows: dict[str, dict[int, float]] = {}
    for i, s in enumerate(subjects):
        for kind, weight in WEIGHTS.items():
            for term in TERMS.get(s, {}).get(kind, "").split(","):
                if term := folded(term):
                    row = rows.setdefault(term, {})
                    row[i] = max(row.get(i, 0), weight)
    words = {s: {folded(w) for w in re.findall(r"[^\W\d_]{4,}", (text or "").lower()) if w not in COMMON} | {folded(re.sub(r"[\W_]+", " ", s))} - {""} for s, text in areas}
    used = Counter(w for found in words.values() for w in found)
    for s, found in words.items():
        for w in found:
            if used[w] == 1 and w not in rows:
                rows[w] = {subjects.index(s): WEIGHTS["plain"]}
    terms = tuple(sorted(rows))
    weight = np.zeros((len(terms), len(subjects)))
    for k, t in enumerate(terms):
        for i, w in rows[t].items():
            weight[k, i] = w
    beside = ((weight > 0).sum(1) > 1) | (weight.max(1, initial=0) <= WEIGHTS["loose"])
    return Lexicon(subjects, terms, weight, beside)


@lru_cache(maxsize=4)
def automaton(terms: tuple[str, ...]):
    """The terms and their forms, as whole words, as one automaton; a term goes before another's form."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        for form in forms(term):
            if not found.exists(f" {form} "):
                found.add_word(f" {form} ", (k, len(form) + 2))
    for k, term in enumerate(terms):
        found.add_word(f" {term} ", (k, len(term) + 2))
    found.make_automaton()
    return found


def counted(text: str | None, terms: tuple[str, ...]) -> tuple[dict[int, int], int]:
    """How often each term stands in the readable text (the longest where several overlap), and the number of words."""
    words = folded(readable(text))
    counts: dict[int, int] = {}
    if not words or not terms:
        return counts, words.count(" ") + bool(words)
    hits = sorted((last - size, -size, k) for last, (k, size) in automaton(terms).iter(f" {words} "))
    free = -1
    for start, size, k in hits:
        if start >= free:
            counts[k] = counts.get(k, 0) + 1
            free = start - size - 1  # the blank at its end may begin the next
    return counts, words.count(" ") + 1


SHARE, DENSITY = 0.16, 1.0  # of the weight of all terms found; of 100 words: where there are no labels
PRIOR = 0.5  # what a share is measured against besides, in terms of average weight, so that few terms say less
SHARES, DENSITIES = np.arange(4, 41) / 100, np.arange(0, 13) / 4  # the thresholds that are tried


def counts(docs: DataFrame, row_id: str, text: str, terms: tuple[str, ...]) -> DataFrame:
    """id, terms, times, n_words: the numbers of the terms in each document, how often each occurs, and its length."""
    rows = docs.select(F.col(row_id).alias("id"), F.col(text).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                found = [counted(t, terms) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([list(c) for c, _ in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c, _ in found], pa.list_(pa.int32())), pa.array([w for _, w in found], pa.int64())], names=["id", "terms", "times", "n_words"])

    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, terms array<int>, times array<int>, n_words long")


def rarity(counted: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """The weight of each term by the share of all documents that have it (0 if all have), such that a term found has
    weight 1 on average, its curated weight included."""
    n = counted.count()
    docs, times = np.zeros(len(lexicon.terms)), np.zeros(len(lexicon.terms))
    for r in counted.select(F.explode(F.arrays_zip("terms", "times")).alias("t")).groupBy("t.terms").agg(F.count("*"), F.sum("t.times")).collect():  # one row a term
        docs[r[0]], times[r[0]] = r[1], r[2]
    rare = np.log((n + 1) / (docs + 1)) + 1 / (n + 1)
    mean = (times * rare * lexicon.weight.max(1, initial=0)).sum() / max(times.sum(), 1)
    return rare / mean if mean > 0 else rare


def measured(terms: pa.ListArray, times: pa.ListArray, n_words: np.ndarray, lexicon: Lexicon, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's subjects (documents x subjects): share of the weight found, and weighted hits in 100 words.

    A term that counts only beside others is divided among its subjects as the document's other terms are; without such,
    it counts for none.
    """
    n = len(n_words)
    grid = np.zeros((n, len(rare)))
    lengths = np.diff(terms.offsets.to_numpy())
    grid[np.repeat(np.arange(n), lengths), terms.flatten().to_numpy()] = times.flatten().to_numpy()
    usual = lexicon.weight / WEIGHTS["plain"]
    heavy = lexicon.weight * rare[:, None]
    firm = ~lexicon.beside
    score, hits = grid[:, firm] @ heavy[firm], grid[:, firm] @ usual[firm]
    alone = score.copy()
    for k in np.flatnonzero(lexicon.beside & grid.any(0)):
        part = alone * (lexicon.weight[k] > 0)
        whole = part.sum(1, keepdims=True)
        part = np.divide(part, whole, out=np.zeros_like(part), where=whole > 0) * grid[:, [k]]
        score += part * heavy[k]
        hits += part * usual[k]
    return score / (score.sum(1, keepdims=True) + PRIOR), 100 * hits / np.maximum(n_words, 1)[:, None]


@dataclass(frozen=True)
class Thresholds:
    """What a subject must reach, and how thresholds found in the same way do on labelled documents that weren't used."""

    share: float = SHARE
    density: float = DENSITY
    precision: float | None = None
    recall: float | None = None
    n_held_out: int = 0


def fitted(wrong: np.ndarray) -> tuple[int, int]:
    """Which thresholds are best, by the number of errors of each.

    Labels are not all right, so the errors of neighbouring thresholds are averaged, and the middle of the best is taken.
    """
    smooth = wrong.astype(float)
    for axis, width in ((0, 5), (1, 2)):
        smooth = sum(np.take(smooth, np.clip(np.arange(wrong.shape[axis]) + d, 0, wrong.shape[axis] - 1), axis) for d in range(-width, width + 1)) / (2 * width + 1)
    # errors vary by their root: all that are as good as the best but for half of that are one plateau, whose middle counts
    i, j = np.nonzero(smooth <= smooth.min() + 0.5 * np.sqrt(smooth.min()) + 1e-9)
    return int(np.median(i)), int(np.median(j))


def calibrated(counted: DataFrame, labels: DataFrame, row_id: str, lexicon: Lexicon, given: np.ndarray, rare: np.ndarray) -> Thresholds:
    """Thresholds from all labelled documents.  Two halves of these, by hash, tell how well that does: each is measured
    with the thresholds that the other one alone would give.

    Each document and subject counts in one cell of a histogram, by half, label, and the thresholds that it reaches; only
    the sums of the cells are gathered.
    """
    marked = labels.select(F.col(row_id).alias("id"), "subject").where(F.col("id").isNotNull()).groupBy("id").agg(F.collect_set("subject").alias("s"))
    rows = counted.join(marked, "id").select("terms", "times", "n_words", "s", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(2)).alias("half"))
    shape = (2, 2, len(SHARES) + 1, len(DENSITIES) + 1)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(np.prod(shape), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                terms, times, n_words, subjects, half = (pa.concat_arrays([x]) for x in batch.slice(at, 1000).columns)
                share, density = (x[:, given] for x in measured(terms, times, n_words.to_numpy(), lexicon, rare))
                truth = np.array([[s in found for s in lexicon.subjects] for found in map(set, subjects.to_pylist())])[:, given]
                place = (np.broadcast_to(half.to_numpy()[:, None], truth.shape), truth.astype(np.int64), np.searchsorted(SHARES, share, "right"), np.searchsorted(DENSITIES, density, "right"))
                cells += np.bincount(np.ravel_multi_index(place, shape).ravel(), minlength=len(cells))
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    cells = np.zeros(np.prod(shape), np.int64)
    for r in rows.mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # one row a cell
        cells[r[0]] = r[1]
    cells = cells.reshape(shape)
    if not cells.any():
        return Thresholds()
    reached = cells[..., ::-1, ::-1].cumsum(-1).cumsum(-2)[..., ::-1, ::-1][..., 1:, 1:]  # half, label, share, density
    labelled = cells[:, 1].sum((1, 2))
    wrong = reached[:, 0] + labelled[:, None, None] - reached[:, 1]
    i, j = fitted(wrong.sum(0))
    n_held_out = found = right = true = 0
    for half in (0, 1):
        if cells[0].any() and cells[1].any():
            at = fitted(wrong[1 - half])
            n_held_out += int(cells[half].sum()) // int(given.sum())
            found, right, true = found + reached[half].sum(0)[at], right + reached[half, 1][at], true + labelled[half]
    out = Thresholds(float(SHARES[i]), float(DENSITIES[j]), float(right / max(found, 1)), float(right / max(true, 1)), n_held_out)
    log.info("subjects: share %.2f, density %.2f; on %d labelled documents, each held out once: precision %.3f, recall %.3f", out.share, out.density, out.n_held_out, out.precision, out.recall)
    return out


def given_areas(areas: DataFrame) -> tuple[tuple[str, str | None], ...]:
    """(subject, description), each subject once: few rows, that someone wrote."""
    text = "description" if "description" in areas.columns else F.lit(None).cast("string")
    return tuple(sorted((r[0], r[1]) for r in areas.where("subject is not null").groupBy("subject").agg(F.max(text)).collect()))


def subject_areas(docs: DataFrame, row_id: str, text: str, areas: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """row_id, subject, share, n_words: each subject of `areas` that a document treats in a substantial part.

    A subject is assigned if its terms make up enough of the weight of all terms found in the document and stand
    often enough for its length.  Rare terms weigh more; rarity comes from all documents, the two thresholds from
    labelled ones.  Terms of subjects that aren't in `areas` count too, as a document is shared among all.  An area that
    the lexicon doesn't know is found by its name and the words of its description; one without any is logged, and
    listed by `composition` with n_terms = 0.  Documents without readable content (null, empty, comments or
    includes only) have no subject.  row_id must be unique.  An empty table gives no rows; other columns are not read.
    """
    wanted = given_areas(areas)
    words = lexicon(wanted)
    given = np.array([s in {x for x, _ in wanted} for s in words.subjects], bool)
    if words.without_terms:
        log.warning("no terms are known of %s", ", ".join(words.without_terms))
    seen = settled(counts(docs, row_id, text, words.terms))
    rare = rarity(seen, words)
    least = calibrated(seen, labels, row_id, words, given, rare) if labels is not None else Thresholds()
    names = np.array(words.subjects, object)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = pa.RecordBatch.from_arrays([pa.concat_arrays([x]) for x in batch.slice(at, 1000).columns], names=batch.schema.names)
                length = some.column(3).to_numpy()
                share, density = measured(some.column(1), some.column(2), length, words, rare)
                doc, k = np.nonzero((share >= least.share) & (density >= least.density) & (share > 0) & given)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(doc)), pa.array(names[k].tolist(), pa.string()), pa.array(share[doc, k]), pa.array(length[doc])], names=["id", "subject", "share", "n_words"])

    return seen.mapInArrow(assign, f"id {seen.schema['id'].dataType.simpleString()}, subject string, share double, n_words long").withColumnRenamed("id", row_id)


def composition(found: DataFrame, areas: DataFrame) -> DataFrame:
    """subject, n_docs, n_words, n_terms: of each of `areas`, the documents that treat it, their words, divided by
    each document's shares, and how many terms it is found by. found: `subject_areas`."""
    wanted = given_areas(areas)
    words = lexicon(wanted)
    n_terms = dict(zip(words.subjects, (words.weight > 0).sum(0).tolist()))
    all_ = found.sparkSession.createDataFrame([(s, n_terms[s]) for s, _ in wanted], "subject string, n_terms long")
    sums = found.groupBy("subject").agg(F.count("*").alias("n_docs"), F.round(F.sum(F.col("share") * F.col("n_words"))).cast("long").alias("n_words"))
    return all_.join(sums, "subject", "left").select("subject", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_words", F.lit(0)).alias("n_words"), "n_terms")
