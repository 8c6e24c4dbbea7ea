"""Sentence boundaries in texts of any language and script.

A text is read as a sequence of symbols: blank lines, quotation marks, end marks (each already
classified by the few words around it) and, in Thai, spaces.  A finite transducer runs over the
symbols; its states say which quotation is open, which decides whether a mark after an end mark
closes that quotation or opens the next sentence.

Long texts are cut into chunks.  A chunk, read once for all start states together, is a function
from start state to end state, and its boundaries carry the set of start states that yield them.
Composing the functions by a parallel prefix scan gives every chunk its start state.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestloom.runtime import materialize

CHUNK_CHARS = 16_384
#: Characters before it that a chunk sees, and half as many that are not blank, with all blanks between, behind it.
CONTEXT = 1_024

# ---- the transducer ---------------------------------------------------------------------------

#: Which quotation is open: none, "...", „...“, “...”.
STATES = (0, 1, 2, 3)
PARA, STRAIGHT, LOW, SIX, NINE, MARK = range(6)
#: next state by symbol and state; end marks change nothing
STEP = {
    PARA: (0, 0, 0, 0),
    STRAIGHT: (1, 0, 2, 3),
    LOW: (2, 2, 2, 2),
    SIX: (3, 3, 0, 3),
    NINE: (0, 1, 0, 0),
    MARK: STATES,
}
_QUOTES = {'"': STRAIGHT, "„": LOW, "“": SIX, "”": NINE}

# ---- fixed values -----------------------------------------------------------------------------

_THAI = "ก-๎"
_EVENT = re.compile(
    r"(?P<para>[^\S\n]*\n(?:[^\S\n]*\n)+\s*|\s* \s*)|(?P<mark>[.?!…。？！．｡।॥؟۔]+)|(?P<quote>[\"„“”])"
    rf"|(?P<thai>(?<=[{_THAI}])[^\S\n]+(?=[{_THAI}]))"
)
_CLOSERS = frozenset("”’»›)]}」』）】〉》")
_QUOTE_CLOSERS = frozenset("”’»›」』\"“")
_OPENERS = frozenset("“\"„«‹‘'([{「『（【¿¡*")
_CONTINUING = frozenset(",;:،؛，；：、)]}）】」』”»")
_WIDE = frozenset("。？！．｡")
# abbreviations that a sentence does not end with: something always follows
_NEVER = frozenset(
    "dr prof mr mrs ms mme mlle st ste sr sra srta dra pr gen col capt lt sgt rev hon fr mt ft "
    "fig figs tab tabs sec secs ch chap eq eqs ref refs vol vols pp p pág págs pag art nr núm n° ed eds "
    "cf vs viz misc acc approx aprox ca resp esp incl excl e.g i.e eg ie "
    "abb bd vgl bzgl bzw sog evtl ggf z d h i e s u z.b d.h u.a o.ä s.o "
    "ee проф см рис табл стр т е гл акад доц им ср напр т.е т.к प्रो डॉ श्री पं أ د م ص".split()
)
# abbreviations that a sentence may end with: the next word tells
_MAYBE = frozenset("al etc ltd inc co corp plc bros jr sen a.m p.m am pm uu ss usw u.a a et.al г гг др пр руб тыс м в usf seq ibid dept est no nos ph.d m.d b.c a.d и.др и.т.д".split())
_NUMBERED = frozenset({"no", "nos", "nr"})
_MONTHS = frozenset("januar jänner februar märz april mai juni juli august september oktober november dezember jan feb mär apr jun jul aug sep okt nov dez".split())
_STARTERS = frozenset("The A An In It This That These We He She They However But As For Our No Why What Who".split())
_SPEECH = frozenset("سأل سألت قال قالت أجاب أجابت كتب كتبت صاح صاحت هتف هتفت تساءل تساءلت أضاف أضافت ऐसा ऐसे कहा पूछा बोला बोली बोले लिखा".split())
_SPEECH_SIGN = re.compile(r"[问問说說道写寫答称稱喊叫]")
_SPEAKER = re.compile(r"(?:[^\W\d_a-z][\w.'’-]*\s+){1,3}(?:said|asked|wrote|replied|says|asks|added|answered|noted|remarked)\b")
_PARTICLE = re.compile(r"(?:al-|el-|ibn |bin |von |van |de |di |da |del |della |du |zu |ter )(?:(?:la|der|den|von|van|zu) )?(\w)")
_MIXED = re.compile(r"[a-z]{1,3}[A-Z]")
_NUMBER_START = re.compile(r"\d+\s+\w|\d{1,3}(?:,\d{3})+\s+\w")
_YEAR = re.compile(r"(?:19|20)\d\d\b")
# marks that are part of words without being letters: Latin accents, Devanagari, Thai, Arabic
_MARKS = "\xad\u0300-\u036f\u0900-\u097f\u0e31-\u0e4e\u064b-\u065f"
_TOKEN = re.compile(rf"(?:\w[\w{_MARKS}*]{{0,2}}\.)*[\w{_MARKS}*'’-]*[\w{_MARKS}*]$")
_WORD = re.compile(rf"[\w{_MARKS}'’-]+")
_UNIT_START = re.compile(r"(?:^\s*|\n[^\S\n]*\n\s*)$")
_KANA_NEXT = frozenset("とはがのをもにで")


def _small_start(text: str, at: int) -> bool:
    """A sentence that visibly starts with a small letter: mRNA, al-Name, von Name."""
    if _MIXED.match(text, at):
        return True
    m = _PARTICLE.match(text, at)
    return bool(m and m[1].isupper())


def _starts(text: str, at: int) -> bool:
    """Whether what follows an abbreviation looks like the start of a sentence."""
    while at < len(text) and text[at] in _OPENERS:
        if text[at] in "([（" and text[at + 1 : at + 2].isdigit():
            return False
        at += 1
    c = text[at : at + 1]
    if c.isdigit():
        return not _YEAR.match(text, at)
    if c.islower():
        return _small_start(text, at)
    return c.isalpha()


def _next_word(text: str, at: int) -> str:
    m = _WORD.match(text, at)
    return m[0] if m else ""


def _tail(text: str, at: int, quote_closes: bool) -> int:
    """The end of closing marks from ``at``; ``quote_closes``: a quotation mark before a letter closes."""
    while at < len(text):
        c, after = text[at], text[at + 1 : at + 2]
        if c in _CLOSERS:
            at += 1
        elif c in "\"“":
            if (after.isalnum() or after in _OPENERS and after) and not quote_closes:
                break
            at += 1
        elif c == "*":
            if after.isalnum():
                break
            at += 1
        elif c in "   " and after in ("»", "›"):
            at += 2
        else:
            break
    return at


def _after_quote(text: str, tail: int, at: int, wide: bool) -> bool:
    """Whether a sentence ends with the quotation that ends at ``tail``; else its speaker follows at ``at``."""
    c = text[at]
    if c in "—–-":
        return False
    if wide or "぀" <= c <= "鿿":
        if c in _KANA_NEXT:
            return False
        clause = re.split(r"[。？！]|\n\s*\n", text[at : at + 160], maxsplit=1)[0]
        return not (tail == at and _SPEECH_SIGN.search(clause))
    if c.islower():
        return _small_start(text, at)
    if _next_word(text, at) in _SPEECH:
        return False
    return not _SPEAKER.match(text, at)


def _after_period(text: str, start: int, tail: int, at: int, bare: bool) -> bool:
    """Whether the single period at ``start`` ends a sentence; ``bare``: nothing closes after it."""
    m = _TOKEN.search(text, max(0, start - 40), start)
    token = m[0].replace("\xad", "").replace("*", "") if m else ""
    key = token.casefold()
    if "." in key and key not in _NEVER and key not in _MAYBE and any(len(x) > 1 for x in key.split(".")):
        # no abbreviation in several parts, but a missing space, a host or a number
        token, key = token.rpartition(".")[2], key.rpartition(".")[2]
    last = key.rpartition(".")[2]
    c = text[at]
    if bare and tail == at:  # no space
        if c.isdigit():
            return bool(token) and not token[-1].isdigit() and key not in _NEVER and last not in _NEVER and bool(_NUMBER_START.match(text, at))
        if c.islower():
            return len(token) > 1 and _small_start(text, at) and last not in _NEVER
        if c.isupper():
            if len(last) <= 1 and not last.isdigit() or key in _NEVER or last in _NEVER:
                return False
            after = text[at + 1 : at + 2]
            return after.islower() or not after.isalnum() or (after.isupper() and not token[-1:].isupper())
        if c.isalpha():
            return len(last) > 1
        if c not in _OPENERS:
            return False
    if key in _NEVER or len(token) == 1 and token.isupper():
        return False
    if key in _MAYBE or "." in key and last in _MAYBE:
        if key in _NUMBERED:
            return c.isupper() or c in _OPENERS
        return _starts(text, at)
    if "." in key and len(last) == 1 and last.isalpha():  # U.S.
        return _next_word(text, at) in _STARTERS
    if len(token) == 1 and not token.isdigit() and not token.islower():
        return False
    if token.isdigit() and len(token) <= 3:
        if tail != at and _UNIT_START.search(text, max(0, m.start() - 200), m.start()):  # the number of a heading or list item
            return False
        word = _next_word(text, at)
        if word.casefold().replace("\xad", "") in _MONTHS:
            return False
        if len(token) <= 2 and c.islower():
            return _small_start(text, at)
    return True


def _ends(text: str, start: int, end: int, tail: int) -> tuple[int, int] | None:
    """(end of the sentence, start of the next or -1 if not in sight) if the end mark at [start, end) with closing marks to ``tail`` ends one."""
    at = tail
    n = len(text)
    while at < n and text[at].isspace():
        at += 1
    if at == n:
        return tail, -1
    gap = text[tail:at]
    if gap.count("\n") > 1 or " " in gap:
        return tail, at
    c, mark = text[at], text[start:end]
    wide = mark[-1] in _WIDE
    closing = text[end:tail]
    if c in _CONTINUING:
        return None
    if any(q in _QUOTE_CLOSERS for q in closing):
        return (tail, at) if _after_quote(text, tail, at, wide) else None
    if c in "—–":
        rest = text[at + 1 : at + 3].strip()
        if rest[:1].islower():
            return None
    if wide:
        return tail, at
    if closing and c.islower() and not _small_start(text, at) and closing.strip("*"):
        return None
    if mark == ".":
        return (tail, at) if _after_period(text, start, tail, at, not closing) else None
    if mark[-1] in ".…" and not set(mark) & set("?!؟"):  # ellipsis
        if tail == at and not c.isupper() or c.islower() and not _small_start(text, at):
            return None
        return tail, at
    if tail == at and not closing:
        if c.isdigit():
            return (tail, at) if _NUMBER_START.match(text, at) else None
        if c.islower():
            return (tail, at) if _small_start(text, at) else None
        if not c.isalpha() and c not in _OPENERS:
            return None
    return tail, at


def read(text: str, lo: int, hi: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """The chunk [lo, hi) of a text as (end state by start state, boundaries).

    A boundary is (end, next start or -1, bits of the start states that yield it); all places are
    in ``text``, which may reach beyond the chunk on both sides.
    """
    states = list(STATES)
    out: list[tuple[int, int, int]] = []
    for m in _EVENT.finditer(text):
        at = m.start()
        if at >= hi:
            break
        if at < lo:
            continue
        kind = m.lastgroup
        if kind == "quote":
            step = STEP[_QUOTES[text[at]]]
            states = [step[s] for s in states]
        elif kind == "para":
            out.append((at, m.end() if m.end() < len(text) else -1, 15))
            states = [STEP[PARA][s] for s in states]
        elif kind == "thai":
            out.append((at, m.end(), 15))
        else:
            end = m.end()
            opened = _tail(text, end, False)
            closed = _tail(text, end, True)
            plain = _ends(text, at, end, opened)
            if closed == opened:
                if plain:
                    out.append((*plain, 15))
                continue
            within = _ends(text, at, end, closed)
            # the mark closes only the quotation that is open
            opens = 1 if text[opened] == '"' else 2
            bits = sum(1 << i for i, s in enumerate(states) if s == opens)
            if within and bits:
                out.append((*within, bits))
            if plain and bits != 15:
                out.append((*plain, 15 & ~bits))
    return states, out


def split(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text."""
    n = len(text)
    first = n - len(text.lstrip())
    last = len(text.rstrip())
    out, start = [], first
    for end, following, bits in read(text, 0, n)[1]:
        if bits & 1 and end > start:
            out.append((start, end))
            start = following if following >= 0 else n
    if last > start:
        out.append((start, last))
    return out


# ---- tables -----------------------------------------------------------------------------------


def _whole(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(d, s, e) for d, t in zip(batch["doc_id"], batch["text"], strict=True) for s, e in split(t)]
        yield pd.DataFrame(rows, columns=["doc_id", "start_char", "end_char"])


def _chunk_reader(size: int, context: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, row, k, piece in zip(batch["doc_id"], batch["row"], batch["k"], batch["piece"], strict=True):
                base = max(0, k * size - context)
                lo = k * size - base
                hi = min(lo + size, len(piece))
                fn, found = read(piece, lo, hi)
                own = piece[lo:hi]
                bare = own.strip()
                first = base + lo + len(own) - len(own.lstrip()) if bare else None
                last = base + lo + len(own.rstrip()) if bare else None
                cuts = [{"at_end": e + base, "next_start": n + base if n >= 0 else -1, "bits": b} for e, n, b in found]
                out.append((doc_id, row, k, fn, first, last, cuts))
            yield pd.DataFrame(out, columns=["doc_id", "row", "k", "fn", "first_char", "last_char", "cuts"])

    return run


def prefix_states(chunks: DataFrame, key: list[str]) -> DataFrame:
    """Adds ``state`` to chunks (key, k, fn): the state in which chunk k starts, chunk 0 in state 0.

    Each round composes every function with the one 2^r chunks before it, so a text of n chunks
    takes log2(n) joins, whatever its neighbours do.
    """
    top = chunks.agg(F.max("k")).first()[0] or 0
    done = chunks.select(*key, "k", F.col("fn").alias("run"))
    span = 1
    while span <= top:
        before = done.select(*key, (F.col("k") + span).alias("k"), F.col("run").alias("earlier"))
        composed = F.transform("earlier", lambda s: F.get(F.col("run"), s))
        done = done.join(before, [*key, "k"], "left").select(*key, "k", F.when(F.col("earlier").isNull(), F.col("run")).otherwise(composed).alias("run"))
        span *= 2
        if span in (16, 256, 4096, 65536):
            done = materialize(done, "sentence-prefix")
    start = done.select(*key, (F.col("k") + 1).alias("k"), F.get("run", F.lit(0)).alias("state"))
    return chunks.join(start, [*key, "k"], "left").withColumn("state", F.coalesce("state", F.lit(0)))


def sentences(docs: DataFrame, chunk_chars: int = CHUNK_CHARS, context: int = CONTEXT) -> DataFrame:
    """``doc_id, start_char, end_char`` of every sentence; offsets in characters, end exclusive.

    docs has doc_id and text.  Null and blank texts give no row; repeated rows give theirs again.
    Texts of one chunk are read where they are; only longer ones are cut and spread.
    """
    # ids go as text, since pandas has no integers beside nulls
    docs = docs.select(F.col("doc_id").cast("string"), "text", F.monotonically_increasing_id().alias("row")).where("text IS NOT NULL")
    length = F.char_length("text")
    short = docs.where(length <= chunk_chars).select("doc_id", "text").mapInPandas(_whole, "doc_id string, start_char int, end_char int")
    # every row is a document of its own, so that no text is shuffled
    begin = F.col("k") * chunk_chars
    before = F.substring("text", F.greatest(F.lit(1), begin - context + 1), F.least(begin, F.lit(context)))
    behind = F.regexp_extract(F.substring("text", begin + chunk_chars + 1, length), rf"^(?:\s*+\S){{0,{max(1, context // 2)}}}+", 0)
    cut = docs.where(length > chunk_chars).select("*", F.explode(F.sequence(F.lit(0), F.floor((length - 1) / chunk_chars).cast("int"))).alias("k"))
    pieces = cut.select("doc_id", "row", "k", F.concat(before, F.substring("text", begin + 1, F.lit(chunk_chars)), behind).alias("piece"))
    schema = "doc_id string, row long, k int, fn array<int>, first_char int, last_char int, cuts array<struct<at_end int, next_start int, bits int>>"
    chunks = materialize(pieces.mapInPandas(_chunk_reader(chunk_chars, context), schema), "sentence-chunks")
    started = prefix_states(chunks, ["row"])
    key = ["row", "doc_id"]
    text = Window.partitionBy("row")
    later = text.orderBy("k").rowsBetween(1, Window.unboundedFollowing)
    started = started.select(*key, "state", "cuts", "k", F.first("first_char", ignorenulls=True).over(later).alias("later"), F.min("first_char").over(text).alias("begin"), F.max("last_char").over(text).alias("finish"))
    bounds = started.select(*key, "state", "later", "begin", "finish", "k", F.explode("cuts").alias("cut")).where(F.getbit("cut.bits", F.col("state").cast("int")) == 1)
    bounds = bounds.select(*key, "begin", F.col("cut.at_end").alias("at_end"), F.when(F.col("cut.next_start") >= 0, F.col("cut.next_start")).otherwise(F.col("later")).alias("next_start"))
    closing = started.where("k = 0").select(*key, "begin", F.col("finish").alias("at_end"), F.lit(None).cast("int").alias("next_start"))
    ordered = bounds.unionByName(closing)
    # equal cuts (an end mark before a blank line) and the text's own end come once
    ordered = ordered.groupBy(*key, "begin", "at_end").agg(F.max("next_start").alias("next_start"))
    line = text.orderBy("at_end")
    spans = ordered.select("doc_id", F.coalesce(F.lag("next_start").over(line), "begin").alias("start_char"), F.col("at_end").alias("end_char"))
    return short.unionByName(spans.where(F.col("end_char") > F.col("start_char"))).withColumn("doc_id", F.col("doc_id").cast("long"))
