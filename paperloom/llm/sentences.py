"""Sentence boundaries in any language by a finite transducer, run over chunks as functions of its state.

Each code point gets a class: by its kind, and, where a full stop or a quotation mark is ambiguous, by what stands next
to it (abbreviations, initials, ordinals, dates; opening and closing marks; items of lists; blank lines; spaces between
Thai phrases). The transducer reads classes. Its state is what was read last (a terminator, closing marks, spaces),
whether a quotation or a bracket is open and began inside the sentence, and whether a low opening mark („) waits for the
mark that closes it, which elsewhere opens a quotation; so that mark may be any distance away. It is compiled once into two
tables, next state and boundary, over the states that can be reached, from the rules in ``_step``.

All texts of a batch run side by side, one class per step. A long text is cut into chunks: those after the first run from
every state at once, which makes each a function from state to state; the functions are composed by a prefix scan, and
the chunks run once more from the states they turn out to begin in. The result is that of one pass, wherever it is cut.

Defined results: null and word-less texts have no sentences; a stretch without letters and digits is no sentence; white
space belongs to none; a text that breaks off ends a sentence; repeated texts are cut alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ..runtime import spread

#: Code points per chunk: longer texts are composed of the functions of their chunks.
CHUNK = 512

#: Abbreviations after which a sentence goes on whatever follows.
NEVER = """
    Dr Drs Prof Mr Mrs Ms St Lt Col Gen Sgt Capt Rev Hon Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec Sec Fig Figs Eq Eqs Tab Vol Vols Ch pp vs cf approx viz
    acc resp Abb Abs Nr Bd vgl bzw ggf ca evtl Hr Fr Aufl env fig art chap éd Mme Mlle Sr Sra Srta Dra aprox pág págs núm ej dott prof sig pag cfr tab vedi Exmo
    см рис табл ок проф им ул стр напр тыс डॉ पृ प्रो श्री د ดร นพ
""".split()  # fmt: skip
#: Those after which one begins if a capital follows.
MAYBE = "al etc Inc Ltd Co Corp Jr a.m p.m U.S U.K usw coll cols ecc др г гг Ph.D e.V p.p".split()
#: Those that number what follows.
NUMBERING = "no nos No Nos n nº p P S v Art".split()

CLASSES = "SP PB UP LOW CL HAN TO TH DIG DOT DOTX DOTM QE FULL FULLQ ELL OQ CQ CQJ OQL EQO EQC OB CB REF SYM CONT INV IGN TSP".split()
C = {name: i for i, name in enumerate(CLASSES)}

#: What was read last: nothing, text, a terminator of some kind (q: asks or exclaims, m: after an abbreviation, e: dots,
#: c: of scripts without spaces, r: with a reference mark, '-' : and a closing mark), or one and spaces.
PHASES = "E M Td Tq Tm Te Tc Tcq Tr Td- Tq- Tc- Tcq- Sd Sq Sm Se Sc Scq Sr Sd- Sq- Sc- Scq-".split()
_AFTER = {"DOT": "Td", "DOTM": "Tm", "QE": "Tq", "FULL": "Tc", "FULLQ": "Tcq", "ELL": "Te"}
_NEW = {"UP", "DIG", "CL", "HAN", "TO", "TH", "OQ", "OB", "SYM", "INV", "LOW"}


def _begins(phase: str, kind: str) -> bool:
    """Whether something of ``kind`` after ``phase`` begins a sentence."""
    if phase[0] not in "TS" or kind not in _NEW:
        return False
    spaced, what, closed = phase[0] == "S", phase[1:].rstrip("-"), phase.endswith("-")
    if what == "r":
        return True
    if what == "c":
        return not (closed and kind == "TO")
    if what == "cq":
        return not (closed and kind in ("HAN", "TO") and not spaced)
    if not spaced:  # a full stop inside a number, name or address, unless a script without spaces follows
        return kind in ("HAN", "TO", "TH", "INV") and what in "dq" or (kind == "UP" and what == "q" and not closed) or (kind in ("CL", "OQ") and not closed and what in "dq")
    if what == "d":
        return kind != "LOW"
    if what == "q":
        return kind not in ("LOW",) and not (closed and kind == "CL")
    if what == "m":
        return kind in ("UP", "INV", "OQ", "CL", "HAN", "TH")
    return kind in ("UP", "DIG", "INV")  # dots


def _step(state: tuple[str, int, int, bool], kind: str) -> tuple[tuple[str, int, int, bool], bool]:
    """Next state, and whether a sentence begins here. The last part says that a low mark waits to be closed: then a mark
    like 66 closes, else as its neighbours have it (EQC, EQO)."""
    *rest, low = state
    if kind in ("EQO", "EQC"):
        kind, low = "CQ" if low or kind == "EQC" else "OQ", False
    elif kind == "OQL":
        kind, low = "OQ", True
    after, begins = _turn(*rest, kind)
    return (*after, low and kind != "PB"), begins


def _turn(phase: str, quote: int, bracket: int, kind: str) -> tuple[tuple[str, int, int], bool]:
    """The same without low marks. quote, bracket: 0 none, 1 begun with the sentence, 2 inside it."""
    here = (phase, quote, bracket)
    if kind == "IGN":
        return here, False
    if kind == "PB":
        return ("E", 0, 0), phase != "E"
    inner = quote == 2 or bracket > 0
    if kind in ("SP", "TSP"):
        if phase[0] == "T":
            phase = "S" + phase[1:]
        elif kind == "TSP" and phase == "M" and not inner:
            phase = "Sr"
        return (phase, quote, bracket), False
    if kind in ("CQ", "CQJ"):
        if phase[0] in "TS":
            base = phase[1:].rstrip("-")
            closed = {"d": "Td-", "q": "Tq-", "c": "Tc-", "cq": "Tcq-", "m": "Td-", "e": "Te", "r": "Tr"}[base]
            if base == "cq" and (kind == "CQJ" or quote == 2):
                closed = "Tc-"
            return (closed, 0, bracket), False
        return ("M", 0, bracket), False
    if kind == "CB":
        if phase[0] in "TS" and bracket:
            base = phase[1:].rstrip("-")
            return ({"d": "Td-", "q": "Tq-", "c": "Tc-", "cq": "Tcq-", "m": "Td-", "e": "Te", "r": "Tr"}[base] if bracket == 1 or base != "m" else "M", quote, 0), False
        return ("M" if phase[0] != "T" else phase, quote, 0), False
    if kind == "REF":
        return ("Tr" if phase[0] == "T" and not inner else "M", quote, bracket), False
    begins = not inner and _begins(phase, kind)
    if begins:
        phase, quote, bracket = "E", 0, 0
    if kind in _AFTER:
        if kind == "DOTM" and phase in ("Td", "Tq"):
            kind = "DOT"
        return (_AFTER[kind], quote, bracket), begins
    if kind == "OQ":
        return ("M", 1 if phase == "E" else 2 if quote != 1 else quote, bracket), begins
    if kind == "OB":
        return ("M", quote, 1 if phase == "E" else 2), begins
    return ("M", quote, bracket), begins


def _compile() -> tuple[np.ndarray, np.ndarray]:
    number = {("E", 0, 0, False): 0}
    rows = []
    for state in (waiting := list(number)):  # grows while it is gone through
        steps = [_step(state, kind) for kind in CLASSES]
        for after, _ in steps:
            if after not in number:
                number[after] = len(number)
                waiting.append(after)
        rows.append(steps)
    return np.array([[number[after] for after, _ in row] for row in rows], np.uint16), np.array([[begins for _, begins in row] for row in rows])


FOLLOW, BEGINS = _compile()
START = 0  # nothing read, nothing open


def _class_table() -> np.ndarray:
    """The class of every code point that needs no neighbours."""
    text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\x00" for c in range(0x110000))
    table = np.full(0x110000, C["SYM"], np.uint8)
    rules = [
        (r"\p{L}", "CL"), (r"\p{Ll}", "LOW"), (r"[\p{Lu}\p{Lt}]", "UP"), (r"\p{N}", "DIG"), (r"[\p{M}\p{Cf}]", "IGN"), (r"[\p{Han}\p{Hiragana}\p{Katakana}ーｰ々]", "HAN"), (r"と", "TO"),
        (r"\p{Thai}", "TH"), (r"[\p{Z}\s\x1c-\x1f]", "SP"), (r"[!?؟]", "QE"), (r"[。．｡]", "FULL"), (r"[！？]", "FULLQ"), (r"[।॥]", "FULL"), (r"…", "ELL"), (r"\.", "DOT"), (r"[,;:،؛、，；：/]", "CONT"),
        (r"[¿¡]", "INV"), (r"[“„‟‘‚«‹「『《〈]", "OQ"), (r"„", "OQL"), (r"[”’»›》〉]", "CQ"), (r"[」』]", "CQJ"), (r"[(\[{（［【]", "OB"), (r"[)\]}）］】]", "CB"),
    ]
    for pattern, name in rules:
        for found in regex.finditer(pattern, text):
            table[found.start()] = C[name]
    return table


_TABLE: list[np.ndarray] = []

_BLANK = regex.compile(r"(?:\r\n|[\n\r\x85\x0b\x0c ])[^\S\n\r]*(?=[\n\r\x85 ])| |\x0c")
_LINE = regex.compile(r"(?m)^[^\S\n\r]*(?P<mark>[•◦▪‣·]|[-*–—+](?=\s)|(?P<num>\d{1,3})(?:[.)]|\)\.)(?=\s)|[a-zA-Z]\)(?=\s)|\((?:\d{1,3}|[a-z])\)(?=\s))")
_NEVER, _MAYBE, _NUMBERING = frozenset(NEVER), frozenset(MAYBE), frozenset(NUMBERING)
#: German words before an ordinal.
_ORDINAL = frozenset("im am der die das den dem des vom zum beim seit bis ab".split())
_DATE = regex.compile(r"(?<!\d)\d{4}\. ?\d{1,2}\. ?\d{1,2}\.")
_MARK = regex.compile(r"[.!?]")
_JOINED = regex.compile(r"(?<=[\p{Ll}\p{N}%)\]])\.(?=\p{Lu}(?:\p{Ll}|\s))")  # a sentence begins without a space
_DOTS = regex.compile(r"\.(?:\s?\.){2,}|…+")
_REFERENCE = regex.compile(r"(?<=[.!?。！？][\"”’»)]{0,2})(?:\[\d+(?:\s?[,–-]\s?\d+)*\]|[⁰¹²³⁴-⁹]+)")
_STRAIGHT = regex.compile(r"[\"'“’‘]")
_THAI = regex.compile(r"(?<=[ก-๛])[^\S\n\r]+(?=[ก-๛“\"])")


def _word_before(text: str, end: int) -> str:
    while end and text[end - 1].isspace():
        end -= 1
    start = end
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:end]


def _stops(text: str, out: np.ndarray) -> None:
    """Which full stops end no sentence, or only before a capital; and words like mRNA that begin one."""
    n = len(text)
    for found in _MARK.finditer(text):
        i = found.start()
        after = i + 1
        while after < n and text[after] in "\"”'»)]":
            after += 1
        spaced = after < n and text[after].isspace()
        while after < n and text[after].isspace():
            after += 1
        if spaced and after + 1 < n and text[after].islower() and text[after + 1].isupper():
            out[after] = C["UP"]
        if text[i] != ".":
            continue
        start = i
        while start and (text[start - 1].isalpha() or "\u0900" <= text[start - 1] <= "\u0e7f"):
            start -= 1
        word, before = text[start:i], text[start - 1] if start else " "
        if not word:
            if before.isdigit() and i + 1 < n and text[i + 1].isspace():
                while start and text[start - 1].isdigit():
                    start -= 1
                if i - start <= 2 and start and text[start - 1] == " " and _word_before(text, start).lower() in _ORDINAL:
                    out[i] = C["DOTX"]
            continue
        if before == ".":
            far = start
            while far and (text[far - 1].isalpha() or text[far - 1] == "."):
                far -= 1
            if text[far:i] in _MAYBE:
                out[i] = C["DOTM"]
            elif len(word) == 1:
                out[i] = C["DOTX"]
        elif before.isdigit():
            continue
        elif word in _NUMBERING and after < n and text[after].isdigit():
            out[i] = C["DOTX"]
        elif word in _NEVER:
            out[i] = C["DOTX"]
        elif word in _MAYBE:
            out[i] = C["DOTM"]
        elif len(word) == 1 and i + 1 < n and (text[i + 1].isspace() or text[i + 1] == "-"):
            out[i] = C["DOTX"]


def classes(text: str) -> np.ndarray:
    """The class of every code point of a text."""
    if not _TABLE:
        _TABLE.append(_class_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _TABLE[0][codes]
    if "." in text:
        for found in _JOINED.finditer(text):
            out[found.start()] = C["FULL"]
    _stops(text, out)
    if "." in text:
        for found in _DATE.finditer(text):
            out[[i for i in range(found.start(), found.end()) if text[i] == "."]] = C["DOTX"]
        at = text.find("c.-à-d.")
        while at >= 0:
            out[at + 1] = out[at + 6] = C["DOTX"]
            at = text.find("c.-à-d.", at + 7)
    if "฀" <= max(text) and _THAI.search(text):
        for found in _THAI.finditer(text):
            out[found.start()] = C["TSP"]
    for found in _DOTS.finditer(text):
        out[found.start() : found.end()] = C["ELL"]
    for found in _REFERENCE.finditer(text):
        out[found.start() : found.end()] = C["REF"]
    for found in _STRAIGHT.finditer(text):
        i = found.start()
        before, after = text[i - 1] if i else " ", text[i + 1] if i + 1 < len(text) else " "
        mark = found.group()
        lead = before.isspace() or before in "([{«„“¿¡–—-:：" or not (before.isprintable())
        if mark == '"':
            out[i] = C["OQ"] if lead and not after.isspace() else C["CQ"]
        elif mark == "'" or mark == "’":
            if lead and after.isalnum() and mark == "'":
                out[i] = C["OQ"]
            elif before in ".!?,…" and not after.isalnum():
                out[i] = C["CQ"]
            elif mark == "'" and not before.isspace() and not after.isalnum() and before.isalnum():
                out[i] = C["CQ"]
            else:
                out[i] = C["IGN"]
        elif mark == "“":
            out[i] = C["EQC"] if not before.isspace() and (after.isspace() or after in ",.;:)") else C["EQO"]
    previous = -2
    for found in _BLANK.finditer(text):
        out[found.start()] = C["PB"]
    first = True
    mark = None
    start = 0
    for line in regex.split(r"(\r\n|[\n\r\x85  ])", text) if "\n" in text or "\r" in text or "\x85" in text or " " in text else [text]:
        if line and line[0] in "\n\r\x85  ":
            previous = start
            start += len(line)
            continue
        if line and not line.isspace():
            item = _LINE.match(line)
            kind_ = None if not item else "1" + item["mark"][-1] if item["num"] else item["mark"] if not item["mark"][0].isalnum() else "a)"
            if kind_ and (first or kind_ == mark):
                if not first and previous >= 0:
                    out[previous] = C["PB"]
                a, b = start + item.start("mark"), start + item.end("mark")
                out[a:b] = np.where(np.isin(out[a:b], (C["DIG"],)), C["DIG"], C["SYM"])
                mark = kind_
            elif first:
                mark = None
            first = False
        elif start or not line:
            first, mark = True, None
        start += len(line)
    return out


def _run(block: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of ``block`` (classes, 255 beyond the end) in step from their states: last states and boundaries."""
    marks = np.zeros(block.shape, bool)
    for i in range(block.shape[1]):
        kinds = block[:, i]
        live = np.flatnonzero(kinds != 255)
        if not len(live):
            break
        now, kind = states[live], kinds[live]
        marks[live, i] = BEGINS[now, kind]
        states[live] = FOLLOW[now, kind]
    return states, marks


_NEXT = np.concatenate([FOLLOW, np.arange(len(FOLLOW), dtype=FOLLOW.dtype)[:, None]], axis=1)  # beyond the end a state stays
#: Steps after which states that have met are followed as one.
_MERGED = frozenset([0, 1, 3, *(8 << 2 * i for i in range(12))])


def _functions(block: np.ndarray) -> np.ndarray:
    """Each row of classes as a function from state to state; states that meet go on together."""
    n, rows = len(FOLLOW), len(block)
    owner, now, place = np.repeat(np.arange(rows), n), np.tile(np.arange(n, dtype=FOLLOW.dtype), rows), np.arange(rows * n)
    kinds = np.minimum(block, len(CLASSES))
    for i in range(block.shape[1]):
        now = _NEXT[now, kinds[owner, i]]
        if i in _MERGED:
            met, back = np.unique(owner * n + now, return_inverse=True)
            owner, now, place = met // n, (met % n).astype(FOLLOW.dtype), back[place]
    return now[place].reshape(rows, n)


def scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of functions, in as many rounds as the logarithm of their number."""
    out, step = functions.copy(), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step].astype(np.int64), axis=1)
        out = np.concatenate([out[:step], later])
        step *= 2
    return out


def _blocks(pieces: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Pieces of like length together, padded."""
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    for a in range(0, len(order), 512):
        rows = order[a : a + 512]
        block = np.full((len(rows), max(len(pieces[i]) for i in rows)), 255, np.uint8)
        for k, i in enumerate(rows):
            block[k, : len(pieces[i])] = pieces[i]
        yield rows, block


def ends(texts: list[str | None], chunk: int = CHUNK) -> list[list[int]]:
    """Of each text the ends of its sentences, in code points from its start."""
    kinds = [classes(t) if t else np.zeros(0, np.uint8) for t in texts]
    pieces, owner = [], []
    for i, k in enumerate(kinds):
        for a in range(0, len(k), chunk):
            pieces.append(k[a : a + chunk])
            owner.append((i, a))
    starts = np.full(len(pieces), START, FOLLOW.dtype)
    followed = [k for k in range(len(pieces) - 1) if owner[k][0] == owner[k + 1][0]]  # the chunks that others follow
    functions = np.empty((len(followed), len(FOLLOW)), FOLLOW.dtype)
    for rows, block in _blocks([pieces[k] for k in followed]):
        functions[rows] = _functions(block)
    a = 0
    while a < len(followed):  # of each long text the states that its chunks begin in
        b = a + 1
        while b < len(followed) and owner[followed[b]][0] == owner[followed[a]][0]:
            b += 1
        starts[followed[a] + 1 : followed[b - 1] + 2] = scan(functions[a:b])[:, START]
        a = b
    found: list[list[int]] = [[] for _ in texts]
    for rows, block in _blocks(pieces):
        _, marks = _run(block, starts[rows])
        r, c = np.nonzero(marks)
        for k, at in zip(r.tolist(), c.tolist(), strict=True):
            i, offset = owner[rows[k]]
            found[i].append(offset + at)
    return [_closed(t, k, sorted(f)) if t else [] for t, k, f in zip(texts, kinds, found, strict=True)]


def _marked(*names: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[C[x] for x in names]] = True
    return table


_SPACE, _LETTER = _marked("SP", "PB", "TSP"), _marked("UP", "LOW", "CL", "HAN", "TO", "TH")
_SPOKEN = _LETTER | _marked("DIG")


def _closed(text: str, kinds: np.ndarray, begins: list[int]) -> list[int]:
    """Ends of the stretches before each begin, white space off, of those that hold letters or digits."""
    if not _LETTER[kinds].any():
        return []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    visible = np.flatnonzero(~_SPACE[kinds] & (codes != 0x200B) & (codes != 0xFEFF))
    at = np.array([*begins, len(kinds)])
    spoken = np.concatenate([[0], np.cumsum(_SPOKEN[kinds])])[at]
    held = np.diff(spoken, prepend=0) > 0
    return (visible[np.searchsorted(visible, at[held]) - 1] + 1).tolist()


def sentence_ends(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Rows (kept columns, end_pos), one per sentence of ``text``. Narrow: no shuffle."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + ["end_pos int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                found = ends(part.column(text).to_pylist())
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(rows) for c in keep), pa.array([x for f in found for x in f], pa.int32())], [*keep, "end_pos"])

    return spread(df.select(*keep, text)).mapInArrow(run, schema)
