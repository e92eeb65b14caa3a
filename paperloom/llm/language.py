"""Languages of texts, whole or mixed, by interpolated Kneser-Ney character models.

One model per language gives the probability of each character after the up to four before it, within a word. All models
share their n-grams: one sorted array of hashes with a column of log probabilities and of back-off weights per language.
A text is cut into sentences; a sentence belongs to the language with the least cross-entropy per character, unless it is
too short, too unlike what its model was trained on or too close between two languages. How unlike a text of a language may
be is calibrated per language and length on held-out halves; beyond that it is in none of the languages known.

Defined results: null, empty and word-less texts have no language; mark-up is no text; a sentence that isn't decided takes
part in the sums of the whole text only; a text of undecided sentences gets the language of the sums, or ``und`` where that
is rejected too; repeated texts get the same answer; very long texts are read whole. Segments cover a text from its first
word to its last: what isn't decided belongs to the segment before it, at the beginning to the one after it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import spread

#: Longest n-gram; sentences per language taken for training, by id; code points of each.
ORDER, SAMPLES, SAMPLE_CHARS = 5, 500, 1000
#: Labelled texts looked at to adapt the models to a collection, and sentences per language taken from them.
ADAPT_TEXTS, ADAPT = 3000, 200
#: Characters a script may have besides those of the samples: the share of an unseen one.
ALPHABET = 3000
#: Letters below which a sentence isn't judged alone; nats by which its language must lead, in all and per letter.
MIN_LETTERS, LEAD, LEAD_PER_LETTER = 12, 6.0, 0.08
#: Rejection: standard deviations, for the length at hand, and nats per character above the held-out mean. No language known.
DEVIATIONS, MARGIN, UNKNOWN = 6.0, 0.4, "und"
#: The same for a further language, against each that the text has already.
OTHER_LEAD, OTHER_LEAD_PER_LETTER = 20.0, 0.4

#: Names of languages in labels, next to the two-letter codes.
NAMES = {
    "ar": ("ara", "arabic"), "de": ("deu", "ger", "german"), "en": ("eng", "english"), "es": ("spa", "spanish"), "fr": ("fra", "fre", "french"),
    "hi": ("hin", "hindi"), "it": ("ita", "italian"), "ja": ("jpn", "japanese"), "ko": ("kor", "korean"), "pt": ("por", "portuguese"),
    "ru": ("rus", "russian"), "th": ("tha", "thai"), "zh": ("zho", "chi", "chinese"),
}

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_MARKUP = regex.compile(r"<[^<>]*>|&[a-zA-Z#0-9]+;|\\(?:documentclass|usepackage|begin|end|cite|ref|label)(?:\[[^\]]*\])?\{[^{}]*\}|\\[a-zA-Z]+|\$[^$]*\$|https?://\S+")
_END = regex.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？।]+[\"'”’»）)」』]*|\n+|\s/\s|[|•]")


def label_code(label: Column) -> Column:
    """The two-letter code a label stands for: case, region, three-letter codes and English names aside; null if blank."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([\p{L}]+)", 1))
    known = F.create_map(*(F.lit(x) for code, names in NAMES.items() for name in names for x in (name, code)))
    return F.when(head != "", F.coalesce(known[head], head))


@dataclass
class Model:
    """All languages' models in sorted arrays; a row per n-gram that any sample has."""

    langs: list[str]
    grams: np.ndarray  # sorted hashes
    logp: np.ndarray  # n-gram x language
    contexts: np.ndarray  # sorted hashes
    backoff: np.ndarray  # context x language, log weight
    unseen: np.ndarray  # by language, log probability of a character no sample has
    usual: np.ndarray  # by language, cross-entropy of held-out sentences
    spread: np.ndarray  # by language, its standard deviation for one character; that of n is less by the root of n

    def limits(self, langs: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Greatest cross-entropy of texts of so many characters that is accepted."""
        return self.usual[langs] + DEVIATIONS * self.spread[langs] / np.sqrt(np.maximum(steps, 1)) + MARGIN


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _hashes(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * _MULTIPLIER
    return x ^ (x >> np.uint64(29))


def _gram_hashes(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of each character of the padded words: hashes of the n-grams that end there, place in its word, and word starts."""
    padded = ["\x02" + w + "\x03" for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(p) for p in padded), np.int64, len(padded))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    one = _hashes(codes)
    rows = [one]
    for _ in range(1, ORDER):
        before = np.empty_like(one)
        before[0] = 0
        before[1:] = rows[-1][:-1]
        with np.errstate(over="ignore"):
            rows.append((before * np.uint64(0xD6E8FEB86659FD93)) ^ (before >> np.uint64(31)) + one)
    return rows, place, starts


def _counts(words: list[str]) -> list[Counter]:
    """Kneser-Ney counts by order: raw for the longest, numbers of different predecessors below."""
    raw: list[Counter] = [Counter() for _ in range(ORDER + 1)]
    for word, times in Counter(words).items():
        padded = "\x02" + word + "\x03"
        for end in range(1, len(padded) + 1):
            for n in range(1, min(ORDER, end) + 1):
                raw[n][padded[end - n : end]] += times
    counts: list[Counter] = [Counter(), *(Counter() for _ in range(ORDER))]
    counts[ORDER] = raw[ORDER]
    for n in range(1, ORDER):
        for gram, c in raw[n].items():
            if gram[0] == "\x02":
                counts[n][gram] = c  # nothing stands before a word's start
        for gram in raw[n + 1]:
            counts[n][gram[1:]] += 1
    return counts


def _table(counts: list[Counter]) -> tuple[list[str], np.ndarray]:
    """All n-grams that any language has, and their counts by language."""
    grams = sorted(set().union(*counts))
    place = {gram: i for i, gram in enumerate(grams)}
    table = np.zeros((len(grams), len(counts)))
    for lang, c in enumerate(counts):
        if c:
            table[np.fromiter((place[g] for g in c), np.int64, len(c)), lang] = np.fromiter(c.values(), np.float64, len(c))
    return grams, table


def _train(words: dict[str, list[str]], alphabet: int) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray, list[str]]:
    """Interpolated log probabilities of all n-grams and back-off weights of all contexts, a value per language."""
    langs = sorted(words)
    counts = [_counts(words[lang]) for lang in langs]
    prob: dict[str, np.ndarray] = {}
    back: dict[str, np.ndarray] = {}
    unseen = np.ones(len(langs)) / alphabet
    for n in range(1, ORDER + 1):
        grams, table = _table([c[n] for c in counts])
        if not grams:
            break
        ones, twos = (table == 1).sum(0), (table == 2).sum(0)
        discount = np.where(ones + twos > 0, np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.95), 0.5)
        contexts = list(dict.fromkeys(gram[:-1] for gram in grams))
        place = {context: i for i, context in enumerate(contexts)}
        of = np.fromiter((place[gram[:-1]] for gram in grams), np.int64, len(grams))
        total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
        np.add.at(total, of, table)
        np.add.at(kinds, of, table > 0)
        left = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)  # what the discounts leave to shorter n-grams
        if n == 1:
            unseen = left[0] / alphabet
            lower = np.broadcast_to(unseen, table.shape)
        else:
            lower = left[of] * np.array([prob[gram[1:]] for gram in grams])
            back |= {context: row for context, row in zip(contexts, np.log(left), strict=True)}
        prob |= zip(grams, np.maximum(table - discount, 0) / np.maximum(total[of], 1) + lower, strict=True)
    return {gram: np.log(p) for gram, p in prob.items()}, back, np.log(unseen), langs


def _sorted(table: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    grams = sorted(table, key=len)
    hashes = np.concatenate([np.zeros(0, np.uint64), *(_hash_of(list(same), n) for n, same in groupby(grams, key=len))])
    order = np.argsort(hashes)
    return hashes[order], np.array([table[grams[i]] for i in order], np.float32)


def _hash_of(grams: list[str], size: int) -> np.ndarray:
    codes = _hashes(np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)).reshape(len(grams), size)
    h = codes[:, 0]
    with np.errstate(over="ignore"):
        for i in range(1, size):
            h = (h * np.uint64(0xD6E8FEB86659FD93)) ^ (h >> np.uint64(31)) + codes[:, i]
    return h


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def fit(samples: list[tuple[str, str]], *, calibrated: bool = True) -> Model:
    """Train on (language, sentence) rows; the rejection limits are calibrated on two held-out halves, or there are none."""
    langs = sorted({lang for lang, _ in samples})
    model = _fitted(samples, langs)
    if not calibrated:
        return model
    found = defaultdict(list)
    for half in (0, 1):
        held = _fitted(samples[half::2], langs)
        for lang, text in samples[1 - half :: 2]:
            if words := words_of(text):
                steps = sum(map(len, words)) + len(words)
                found[lang].append((-score_words(held, words).sum(0)[held.langs.index(lang)] / steps, steps))
    for i, lang in enumerate(model.langs):
        if rows := np.array(found[lang]).reshape(-1, 2).tolist():
            entropy, steps = np.array(rows).T
            model.usual[i] = np.average(entropy, weights=steps)
            model.spread[i] = np.sqrt(np.mean((entropy - model.usual[i]) ** 2 * steps))
    return model


def _fitted(rows: list[tuple[str, str]], langs: list[str]) -> Model:
    words: dict[str, list[str]] = {lang: [] for lang in langs}
    for lang, text in rows:
        words[lang] += words_of(text)
    prob, back, unseen, _ = _train(words, ALPHABET)
    return Model(langs, *_sorted(prob), *_sorted(back), unseen.astype(np.float32), np.full(len(langs), np.inf), np.zeros(len(langs)))


def adapt(model: Model, samples: list[tuple[str, str]], labelled: list[tuple[str, str]]) -> Model:
    """Train again with sentences of labelled texts of the collection, where the first model bears the label out.

    A text counts if its language by the first model is its label. Of it, sentences clearly in another language are left
    out. The limits are calibrated anew with them.
    """
    more: dict[str, list[str]] = defaultdict(list)
    for lang, text in labelled:
        if lang not in model.langs or len(more[lang]) >= ADAPT:
            continue
        parts = [(part, words) for part in sentences(text) if len(words := words_of(part)) >= 3 or (words and words[0] >= "\u0e00")]
        if not parts:
            continue
        sums = np.stack([score_words(model, words).sum(0) for _, words in parts])
        own = model.langs.index(lang)
        if int(np.argmax(sums.sum(0))) != own:
            continue
        for (part, words), row in zip(parts, sums, strict=True):
            if row.max() - row[own] < 2 * OTHER_LEAD_PER_LETTER * sum(map(len, words)):
                more[lang].append(part)
    return fit(samples + [(lang, part) for lang in model.langs for part in more[lang][:ADAPT]])


def _find(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return at, table[at] == hashes


def score_words(model: Model, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language."""
    if not words:
        return np.zeros((0, len(model.langs)), np.float32)
    grams, place, starts = _gram_hashes(words)
    at, seen = _find(model.grams, grams[0])
    total = np.where(seen[:, None], model.logp[at], model.unseen)
    for n in range(2, ORDER + 1):
        deep = np.flatnonzero(place >= n - 1)
        if not len(deep):
            break
        at, seen = _find(model.grams, grams[n - 1][deep])
        context, known = _find(model.contexts, grams[n - 2][deep - 1])
        lower = total[deep] + np.where(known[:, None], model.backoff[context], np.float32(0))
        total[deep] = np.where(seen[:, None], model.logp[at], lower)
    total[place == 0] = 0  # a word's start is given
    return np.add.reduceat(total, starts, axis=0)


class Reader:
    """Scores texts; keeps the scores of the words met last."""

    KEPT = 200_000

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        new = list({w for w in words if w not in self.place})
        if len(self.place) + len(new) > self.KEPT:
            self.place, self.scores, new = {}, self.scores[:0], list(set(words))
        if new:
            first = len(self.scores)
            self.place.update((w, first + i) for i, w in enumerate(new))
            self.scores = np.concatenate([self.scores, score_words(self.model, new)])
        return self.scores[np.fromiter((self.place[w] for w in words), np.int64, len(words))]

    def read(self, texts: list[str | None]) -> list[list[tuple[str, float, int]]]:
        """Of each text its languages with confidence and number of sentences, the most used first."""
        out: list[list[tuple[str, float, int]]] = [[] for _ in texts]
        for i, sums, steps, decided, main, _ in self._judged(texts):
            for lang, n in Counter(decided[decided >= 0].tolist()).most_common() or [(main, len(decided))]:
                own = sums[decided == lang].sum(0) if (decided >= 0).any() else sums.sum(0)
                out[i].append((self._name(lang), self._confidence(own, lang, steps.sum()), n))
        return out

    def segments(self, texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
        """Of each text its segments in turn: where they begin and end in code points, language, confidence."""
        out: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
        for i, sums, steps, decided, main, spans in self._judged(texts):
            langs = decided.copy()
            for k in range(1, len(langs)):
                langs[k] = langs[k] if langs[k] >= 0 else langs[k - 1]
            langs[langs < 0] = next((x for x in langs if x >= 0), main)
            first = np.flatnonzero(np.concatenate([[True], langs[1:] != langs[:-1]])).tolist()
            for a, b in zip(first, [*first[1:], len(langs)], strict=True):
                out[i].append((spans[a][0], spans[b - 1][1], self._name(langs[a]), self._confidence(sums[a:b].sum(0), langs[a], steps[a:b].sum())))
        return out

    def _name(self, lang: int) -> str:
        return self.model.langs[lang] if lang >= 0 else UNKNOWN

    @staticmethod
    def _confidence(sums: np.ndarray, lang: int, steps: int) -> float:
        """Of the language against the others; of none, how the best one stands among them."""
        odds = (sums - (sums[lang] if lang >= 0 else sums.max())) / max(1.0, steps**0.5)
        return float(1 / np.exp(odds).sum())

    def _judged(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int, list[tuple[int, int]]]]:
        """Of each text with words: its place, and of its sentences sums per language, characters, the language decided on or
        -1; then the language of the whole or -1, and where the sentences lie."""
        block: list[tuple[int, list[str], tuple[int, int]]] = []
        size = 0
        for i, text in enumerate(texts):
            for sentence, at in spans(text) if text else ():
                if words := words_of(sentence):
                    block.append((i, words, at))
                    size += len(words)
            if size > 50_000:
                yield from self._decide(block)
                block, size = [], 0
        if block:
            yield from self._decide(block)

    def _decide(self, block: list) -> Iterator[tuple]:
        flat = [w for _, words, _ in block for w in words]
        rows = self._rows(flat)
        counts = np.fromiter((len(words) for _, words, _ in block), np.int64, len(block))
        letters = np.fromiter((sum(map(len, words)) for _, words, _ in block), np.int64, len(block))
        sums = np.add.reduceat(rows, np.cumsum(counts) - counts, axis=0).astype(np.float64)
        owner = np.fromiter((i for i, _, _ in block), np.int64, len(block))
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        whole = np.add.reduceat(sums, first, axis=0)
        main = np.repeat(np.argmax(whole, axis=1), np.diff(np.concatenate([first, [len(block)]])))
        line = np.arange(len(block))
        best = np.argmax(sums, axis=1)
        top = sums[line, best]
        rest = sums.copy()
        rest[line, best] = -np.inf
        lead = top - rest.max(axis=1)
        steps = letters + counts
        wide = _dense(block)
        known = -top / steps <= self.model.limits(best, steps)
        sure = (letters >= np.where(wide, MIN_LETTERS // 3, MIN_LETTERS)) & known & (lead >= LEAD) & (lead >= LEAD_PER_LETTER * letters)
        sure &= (best == main) | (counts >= 3) | wide
        for a, b, total in zip(first, [*first[1:], len(block)], whole, strict=True):
            if len(set(best[a:b][sure[a:b]].tolist()) | {int(main[a])}) > 1:
                self._further(sums[a:b], best[a:b], sure[a:b], letters[a:b], int(main[a]))
            for other in set(best[a:b][sure[a:b]].tolist()):  # what a language explains best must be like it as a whole, too
                its = np.flatnonzero(best[a:b] == other) + a
                if -top[its].sum() / steps[its].sum() > self.model.limits(np.array(other), steps[its].sum()):
                    sure[its] = False
            lang, length = int(main[a]), steps[a:b].sum()
            lang = lang if -total[lang] / length <= self.model.limits(np.array(lang), length) else -1
            yield owner[a], sums[a:b], steps[a:b], np.where(sure[a:b], best[a:b], -1), lang, [at for _, _, at in block[a:b]]

    @staticmethod
    def _further(sums: np.ndarray, best: np.ndarray, sure: np.ndarray, letters: np.ndarray, main: int) -> None:
        """Of the sure sentences of one text keep those that no language the text has anyway explains nearly as well."""
        top = sums[np.arange(len(best)), best]
        has = [main]
        while len(rest := np.flatnonzero(sure & ~np.isin(best, has))):
            over = top[rest] - sums[rest][:, has].max(axis=1)
            clear = (over >= OTHER_LEAD) & (over >= OTHER_LEAD_PER_LETTER * letters[rest])
            sure[rest[~clear]] = False
            if clear.any():
                has.append(int(best[rest[clear][np.argmax(over[clear])]]))


def _dense(block: list[tuple[int, list[str]]]) -> np.ndarray:
    """True where a sentence is written without spaces: few, long words of other than Latin letters."""
    return np.fromiter((any(c >= "฀" for c in words[0][:1] + words[-1][-1:]) for _, words, _ in block), bool, len(block))


def sentences(text: str) -> list[str]:
    """Stretches of running text; mark-up left out."""
    return [sentence for sentence, _ in spans(text)]


def spans(text: str) -> Iterator[tuple[str, tuple[int, int]]]:
    """The same with where they begin and end in the text, white space off."""
    bare = _MARKUP.sub(lambda found: " " * len(found.group()), text)
    start = 0
    for end, after in [*((found.start(), found.end()) for found in _END.finditer(bare)), (len(bare), len(bare))]:
        part = bare[start:end]
        if left := part.lstrip():
            yield part, (end - len(left), start + len(part.rstrip()))
        start = after


def labelled_samples(samples: DataFrame) -> list[tuple[str, str]]:
    """At most SAMPLES sentences per language of at most SAMPLE_CHARS code points, the same in every run."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy("sample_id", "text")
    rows = samples.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).withColumn("n", F.row_number().over(w)).where(F.col("n") <= SAMPLES)
    return [(r.lang, r.text) for r in rows.select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), "n").orderBy("lang", "n").collect()]


def identify(df: DataFrame, text: str, keep: list[str], model: Model) -> DataFrame:
    """Rows of (kept columns, lang, confidence, n_sentences), one per language of each text."""
    return _read(df, text, keep, model, "read", {"lang": "string", "confidence": "double", "n_sentences": "int"})


def segments(df: DataFrame, text: str, keep: list[str], model: Model) -> DataFrame:
    """Rows of (kept columns, start, end, lang, confidence), one per segment of each text in one language."""
    return _read(df, text, keep, model, "segments", {"start": "int", "end": "int", "lang": "string", "confidence": "double"})


def _read(df: DataFrame, text: str, keep: list[str], model: Model, how: str, fields: dict[str, str]) -> DataFrame:
    """The model goes along with the function; its size is bounded by SAMPLES, SAMPLE_CHARS and the number of languages."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [f"{name} {kind}" for name, kind in fields.items()])
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            answers = getattr(reader, how)(batch.column(text).to_pylist())
            rows = pa.array(np.repeat(np.arange(len(answers)), [len(a) for a in answers]), pa.int64())
            flat = [x for a in answers for x in a]
            found = [pa.array([x[k] for x in flat], kinds[kind]) for k, kind in enumerate(fields.values())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in keep), *found], [*keep, *fields])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)
