"""Variant spellings of personal names.

Suffix blocking: every token of a name is indexed by its ending, together with an institution,
so that overly common endings ("-ova", "-son") are refined by that field before anything is made
of them; a block that is still too large is refined again and again, each time by one more of a
longer ending, the initials and the endings of the name's other parts.  What no refinement makes
smaller is compared in salted pieces.  To survive a typing error inside the ending, the endings
that remain when one of the last letters is left out are indexed too.  Pairs that share a block
are aligned token by token and compared by the ratio of their longest common subsequence; two
different tokens that are both established in the data, as Maria and Marta, are no spellings of
each other.  Equal spellings at one institution are compared once, however many rows have them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestloom.runtime import materialize, union_all

#: Length of the shortest indexed ending.
MIN_SUFFIX = 4
#: Spellings in a block beyond which it is refined, and how often it may be.
COMMON, REFINEMENTS = 200, 3
#: Least LCS ratio of two tokens that are one, and for tokens too short for it, the letters that may differ.
TOKEN_RATIO = 0.7
#: The end of the key under which names without further features stand; they meet all of their block.
BARE = "|."
#: A token is established if it is in at least one of so many distinct names, and in at least so
#: many; two established ones differ unless one is that many times as frequent as the other.
ESTABLISHED, AT_LEAST, APART = 4_000, 10, 50

# fixed values: what stands beside a name without being part of it
_TITLES = frozenset("prof dr phd md mr mrs ms miss sir jr sr ii iii iv dipl ing habil rev hon msc bsc mba dphil".split())
_PARTICLES = frozenset("von van der den de la le di da del della du al el ten ter zu zum zur bin ibn dos das do af av".split())
_RUN = re.compile(r"(?:von|van|der|den|del|de|la|di|al|du){2,}")
_LETTERS = str.maketrans({"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"})
# fixed values: common short and pet forms of given names, by the full name, as name dictionaries
# list them; a default, which a caller may replace.  Rarer short forms follow from rules (``is_short``).
PET_FORMS = """
alexander: alex sasha alec sandy xander al | amara: mara amy | anastasia: ana nastya stacy asya tasia | andrew: andy drew | anne: annie anna ann | anthony: ant tony | antonio: toni tony tonio
barbara: barb babs basia | benjamin: ben benny benji | bernard: bernie bernd | bjorn: bjarne | catherine: cathy cat kate | charles: charlie chuck carl karl | chloe: clo | christina: tina chris
christopher: chris kit topher | daniel: dan danny | david: dave davey | deborah: debbie deb | dmitri: dima mitya dmitry mitja | dorothea: dora thea dorothy dorle dot | edward: ed ned ted eddie teddy
ekaterina: katya katja kate | eleanor: ellie nell nora | elizabeth: liz eliza beth betty lizzie bess lisa | emily: em millie | evgeny: zhenya eugene | farid: fred | francisco: fran francis paco pancho frank cisco
frederick: fred freddy fritz | frederike: rike fred frieda friederike ricky | gabriela: gabi gaby gabriella | george: georgie jorge | gerald: gerry jerry | giovanni: gianni vanni | giuseppe: beppe peppe pino
gregory: greg | guillermo: memo | heinrich: heinz henry hinrich | helen: nell lena | henry: harry hank hal | hugo: huey | ignatius: iggy nacho ignaz | ingrid: inga | irina: ira | ivan: vanya
jacob: jake jakob | james: jim jimmy jamie | jean: jeannot | jennifer: jen jenny | jessica: jess | johannes: hans jo johann joe jan hannes | john: jack johnny jon | jonathan: jon jonny
jose: pepe chepe | joseph: jos joe joey jo sepp | joshua: josh | katherine: kate kathy kit katie kat kay | kenneth: ken kenny | kenji: ken | konstantin: kostya | lawrence: larry laurie | leonard: leo lenny
ludwig: lutz | madeleine: maddy | malgorzata: gosia malgosia margo | margaret: peggy meg maggie marge greta madge rita | maria: masha mariya | matthew: matt | matthias: matt matze mats | mei: may
michael: mike mick micky mitch misha | mikhail: misha | nathaniel: nate nat nathan | nicholas: nick nicky nico | nikolai: kolya | nikolaus: klaus niko nick nico nik | noor: nura | olga: olya olja
patricia: pat patty trish tricia patsy | patrick: pat paddy | peter: pete petya | petra: petie | philip: phil pip | quentin: quin | raymond: ray | rebecca: reba becky becca | richard: rick dick ricky richie
robert: bob rob bobby robbie bert | ronald: ron ronnie | rudolf: rudi | samuel: sam sammy | sergei: seryozha | soren: sorn | sophie: sofie | stephen: steph steve steven stevie | stefan: steffen | susanna: sue susan susie suzy sanna
tatiana: tanya | theodore: theo ted teddy | thomas: tom tommy | timothy: tim timmy | tomasz: tomek tom | ursula: uschi ursel ulla | victoria: vic vicky tori | vladimir: vova volodya | walter: walt
wilhelm: willi willy helmut | william: bill will billy liam willy | xenia: xena ksenia | yuri: yura | zachary: zack zach
"""
#: The likeness of a given name and a badly mistyped one, which counts only beside an equal family name, and of a short form by rule.
WEAK, SHORT = 0.3, 0.45
_CJK = re.compile(r"[぀-ヿ㐀-䶿一-鿿가-힣]{2,}")


class Known:
    """What is known of tokens: the short and pet forms of given names, and which tokens are established in the data.

    ``established`` maps tokens to the number of distinct names that have them and to how many of
    these begin with them.
    """

    def __init__(self, pet_forms: str = PET_FORMS, established: dict[str, tuple[int, int]] | None = None) -> None:
        self.formal: dict[str, frozenset[str]] = {}
        self.forms: dict[str, tuple[str, ...]] = {}
        self.established = established or {}
        for entry in re.split(r"[|\n]", pet_forms):
            if ":" in entry:
                full, forms = entry.split(":")
                full = full.strip()
                self.forms[full] = (full, *forms.split())
                for form in self.forms[full]:
                    self.formal[form] = self.formal.get(form, frozenset()) | {full}

    def full(self, token: str) -> frozenset[str]:
        """The full names that a token is a form of; itself if it is no known given name."""
        return self.formal.get(token) or self.formal.get(base(token)) or frozenset((token,))

    def is_given(self, token: str) -> bool:
        """Whether a token is a given name: by the list, or as an established one that mostly begins names."""
        n, first = self.established.get(token, (0, 0))
        return token in self.formal or base(token) in self.formal or 2 * first > n > 0

    def initials(self, token: str) -> frozenset[str]:
        """The letters that may stand for a token: its own first one, and those of its full and short forms."""
        return frozenset({token[0]} | {form[0] for full in self.full(token) for form in self.forms.get(full, (full,))})

    def conflict(self, a: str, b: str) -> bool:
        """Whether two different tokens are both established, so that neither is a mistyped form of the other."""
        low, high = sorted((self.established.get(a, (0, 0))[0], self.established.get(b, (0, 0))[0]))
        return low > 0 and low * APART >= high and base(a) != base(b)


DEFAULT = Known()


def tokens(name: str | None) -> list[str]:
    """The parts of a name in plain small letters, without titles, suffixes and particles.

    Runs of letters are parts, and hyphens separate.  A name of particles and titles only keeps them.
    """
    if not name:
        return []
    name = re.sub(r"\b((?:von|van|der|den|del|della|de|la|di|al|du)+)(?=[^\W\d_a-zß-ÿ])", r"\1 ", name)  # vanderBerg
    text = unicodedata.normalize("NFKD", name.casefold()).translate(_LETTERS)
    text = "".join(c for c in text if unicodedata.category(c) not in ("Mn", "Cf"))
    text = re.sub(r"\b(?:m\.\s?d|ph\.\s?d)\b", " ", text)
    found = re.findall(r"[^\W\d_]+", re.sub(r"['’`]", "", text))
    if found and all(_CJK.fullmatch(t) or len(t) == 1 and ord(t) > 0x3000 for t in found):
        return ["".join(found)]
    kept = [t for t in found if t not in _TITLES and t not in _PARTICLES and not (len(t) > 3 and _RUN.fullmatch(t))]
    return kept or found


def base(token: str) -> str:
    """The token with umlauts spelled with e brought to their letter."""
    return re.sub(r"(?<=[aou])e(?=[^aeiou])", "", token) if len(token) > 3 else token


def lcs_ratio(a: str, b: str) -> float:
    """Twice the length of the longest common subsequence over the sum of the lengths (bit-parallel)."""
    if not a or not b:
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        m = places.get(c, 0)
        v = ((v + (v & m)) | (v & ~m)) & full
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


def is_short(short: str, long: str) -> bool:
    """Whether one token is a short form of the other by rule: its first three or more letters, these with -i, -ie or -y, it doubled, or with the ending -ochka."""
    if len(short) > len(long):
        short, long = long, short
    stem = re.sub(r"(?:ie|i|y)$", "", short)
    return len(short) > 2 and (long.startswith(short) or len(stem) > 2 and long.startswith(stem) or long in (short + short, re.sub(r"[aeiou]$", "", short) + "ochka"))


def likeness(a: str, b: str, known: Known = DEFAULT) -> float:
    """How well two tokens agree: 1 if equal or forms of one given name, 0.5 or less for an initial or a short form, the LCS ratio if near, else 0."""
    if a == b:
        return 1.0 if len(a) > 1 else 0.5
    if len(a) == 1 or len(b) == 1:
        short, long = (a, b) if len(a) == 1 else (b, a)
        if len(long) == 1:
            return 0.0
        return 0.5 if long[0] == short else 0.4 if short in known.initials(long) else 0.0
    if known.full(a) & known.full(b):
        return 1.0
    if known.conflict(a, b):
        return 0.0
    given = [x for x in (a, b) if known.is_given(x)]
    best = max(lcs_ratio(a, b), lcs_ratio(base(a), base(b)))
    if len(given) == 2 and a in known.formal and b in known.formal:
        return best if best >= 0.85 else 0.0
    if abs(len(a) - len(b)) > 2 and best < 0.85:
        best = 0.0
    for x, y in ((a, b), (b, a)):
        if x in given and y not in known.formal:
            best = max(best, 0.0, *(lcs_ratio(form, y) - 0.01 for full in known.full(x) for form in known.forms.get(full, (full,)) if len(form) > 3))
    least = (0.75 if given else TOKEN_RATIO) if max(len(a), len(b)) > 3 else 0.66
    if best >= least:
        return best
    if given and is_short(a, b):
        return SHORT
    return WEAK if given and best >= 0.6 and a[0] == b[0] else 0.0


def same_name(a: list[str], b: list[str], known: Known = DEFAULT) -> float:
    """The strength with which two names are spellings of one; 0 if they are not.

    Tokens are paired best first, in any order.  A family name must agree as more than an
    initial, another part must agree at least as an initial, and parts may be left out of one
    of the names only.  Names without blanks, as in Chinese, must be equal.
    """
    if len(a) == len(b) == 1:
        return float(a == b and bool(_CJK.fullmatch(a[0])))
    options = sorted(((s, i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (s := likeness(x, y, known))), reverse=True)
    left, right, pairs = set(range(len(a))), set(range(len(b))), []
    for s, i, j in options:
        if i in left and j in right:
            left.remove(i)
            right.remove(j)
            pairs.append((s, a[i], b[j]))
    if left and right:
        return 0.0 if any(known.conflict(a[i], b[j]) for i in left for j in right) else _glued(a, b, left, right, pairs)
    family = [s for s, x, y in pairs if s > 0.5 and (min(len(x), len(y)) > 2 or x == y) and not known.is_given(x) and not known.is_given(y)]
    if not family and not all(known.is_given(x) for x in a):
        return 0.0
    if len(pairs) < 2 or any(s == WEAK for s, _, _ in pairs) and max(family, default=0) < 1:
        return 0.0
    return sum(s for s, _, _ in pairs) / max(len(a), len(b)) + min(len(a), len(b)) * 1e-3


def _glued(a: list[str], b: list[str], left: set[int], right: set[int], pairs: list[tuple[float, str, str]]) -> float:
    """Names whose rest agrees once it is written together: a blank is missing, or a particle is part of the token."""
    x, y = "".join(a[i] for i in sorted(left)), "".join(b[j] for j in sorted(right))
    if pairs and min(len(x), len(y)) > 4 and lcs_ratio(x, y) >= 0.8:
        return (sum(s for s, _, _ in pairs) + lcs_ratio(x, y)) / (len(pairs) + 1)
    return 0.0


def forms(token: str, known: Known = DEFAULT) -> set[str]:
    """What a token is indexed as: its full names if it is a form of a given name, else both spellings of its umlauts, whole and short of one of their last letters."""
    if known.full(token) != {token} or token in known.formal:
        return set(known.full(token))
    out = set()
    for t in {token, base(token)}:
        out |= {t} | ({t[:i] + t[i + 1 :] for i in range(max(0, len(t) - MIN_SUFFIX), len(t))} if len(t) > 3 else set())
    return out


def endings(found: list[str], known: Known = DEFAULT) -> list[str]:
    """The endings under which a name is indexed."""
    return sorted({form[-MIN_SUFFIX:] for t in found if len(t) > 1 for form in forms(t, known)})


def refined(found: list[str], key: str, known: Known = DEFAULT) -> list[str]:
    """The keys that take the place of a too common one: with one more feature of the name beside its ending.

    Features are longer endings of the token, and the initials and endings of the other parts; a
    name that has no more of them has the key of the bare ones.
    """
    ending, *held = key.split("|")
    out: set[str] = set()
    for t in found:
        own = [form for form in forms(t, known) if form.endswith(ending)]
        if own:
            out |= {f"-{form[-n:]}" for form in own for n in (MIN_SUFFIX + 2, MIN_SUFFIX + 4) if len(form) >= n}
            for other in found:
                if other != t:
                    out |= {f"{letter}-" for letter in known.initials(other)}
                    out |= {f"+{form[-MIN_SUFFIX:]}" for form in forms(other, known) if len(form) > 1}
    return sorted({"|".join([ending, *sorted({*held, f})]) for f in out - set(held)}) or [f"{key}{BARE}"]


# ---- tables -----------------------------------------------------------------------------------

def _spelled(known: Known) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            memo: dict[str, tuple[str, float]] = {}
            for name in set(batch["name"]):
                found = tokens(name)
                memo[name] = (" ".join(found), same_name(found, found, known))
            out = batch[["k1", "k2", "g"]].assign(tokens=[memo[n][0] for n in batch["name"]], own=[memo[n][1] for n in batch["name"]])
            yield out[out["own"] > 0]

    return run


def established(spellings: DataFrame) -> dict[str, tuple[int, int]]:
    """The tokens in at least one of ``ESTABLISHED`` distinct names: at most that number times the tokens of a name."""
    names = spellings.select("tokens").distinct()
    n = names.count()
    words = names.select(F.posexplode(F.split("tokens", " ")).alias("pos", "t")).where(F.length("t") > 1)
    counts = words.groupBy("t").agg(F.count("*").alias("n"), F.count_if(F.col("pos") == 0).alias("first"))
    return {r["t"]: (r["n"], r["first"]) for r in counts.where(F.col("n") >= max(AT_LEAST, -(-n // ESTABLISHED))).collect()}


def _indexed(known: object) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(g, e, sid, p) for g, sid, p, t in zip(batch["g"], batch["sid"], batch["is_person"], batch["tokens"], strict=True) for e in endings(t.split(), known.value)]
            yield pd.DataFrame(rows, columns=["g", "key", "sid", "is_person"])

    return run


def _refiner(known: object) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(g, k, sid, p) for g, key, sid, p, t in zip(batch["g"], batch["key"], batch["sid"], batch["is_person"], batch["tokens"], strict=True) for k in refined(t.split(), key, known.value)]
            yield pd.DataFrame(rows, columns=["g", "key", "sid", "is_person"])

    return run


def _strength(known: object) -> Callable[[pd.Series, pd.Series], pd.Series]:
    def strength(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair not in memo:
                memo[pair] = same_name(pair[0].split(), pair[1].split(), known.value)
            out.append(memo[pair])
        return pd.Series(out, dtype="float64")

    return strength


_BLOCK = "g long, key string, sid binary, is_person boolean"


def candidate_pairs(spellings: DataFrame, known: object, common: int = COMMON, refinements: int = REFINEMENTS) -> DataFrame:
    """``sid_a, sid_b``: spellings that share a group and a block, the first of a person; each pair once.

    Blocks of more than ``common`` spellings are refined up to ``refinements`` times; names without
    further features are compared with all of the block, and blocks that are still larger are cut
    into pieces of that size, of which each two are compared apart.
    """
    blocks = materialize(spellings.select("g", "sid", F.col("rep").isNotNull().alias("is_person"), "tokens").mapInPandas(_indexed(known), _BLOCK), "name-blocks")
    ready, found = [], []
    for step in range(refinements + 1):
        sizes = blocks.groupBy("g", "key").agg(F.count("*").alias("n"), F.max("is_person").alias("linked"))
        large = materialize(sizes.where((F.col("n") > common) & F.col("linked")).select("g", "key", "n"), "large-blocks")
        if not large.head(1):
            ready.append(blocks.withColumn("cell", F.lit("")))
            break
        ready.append(blocks.join(large, ["g", "key"], "left_anti").withColumn("cell", F.lit("")))
        members = blocks.join(large, ["g", "key"])
        pieces = F.ceil(F.col("n") / common).cast("int")
        mine = F.pmod(F.xxhash64("sid"), pieces).cast("int")
        every = F.explode(F.sequence(F.lit(0), pieces - 1))
        if step < refinements:
            fine = members.join(spellings.select("sid", "tokens"), "sid").select("g", "key", "sid", "is_person", "tokens").mapInPandas(_refiner(known), _BLOCK).distinct()
            fine = materialize(fine, "name-blocks")
            blocks = fine.where(~F.col("key").endswith(BARE))
            bare = fine.where(F.col("key").endswith(BARE)).withColumn("key", F.expr(f"substring(key, 1, length(key) - {len(BARE)})")).join(large, ["g", "key"])
            bare = bare.select("g", "key", every.alias("cell"), F.col("sid").alias("sid_2"), F.col("is_person").alias("person_2"))
            whole = members.select("g", "key", mine.alias("cell"), "sid", "is_person")
            found.append(_ordered(whole.join(bare, ["g", "key", "cell"])))
        else:
            cells = members.select("g", "key", "sid", "is_person", mine.alias("mine"), every.alias("other"))
            cell = F.concat_ws("-", F.least("mine", "other").cast("string"), F.greatest("mine", "other").cast("string"))
            ready.append(cells.select("g", "key", "sid", "is_person", cell.alias("cell")))
    rows = union_all(ready)
    persons = rows.where("is_person").select("g", "key", "cell", "sid", "is_person")
    others = rows.select("g", "key", "cell", F.col("sid").alias("sid_2"), F.col("is_person").alias("person_2"))
    found.append(_ordered(persons.join(others, ["g", "key", "cell"]).where(~F.col("person_2") | (F.col("sid") < F.col("sid_2")))))
    return union_all(found).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    """``sid_a, sid_b`` of pairs with a person: the person's spelling first, the smaller one of two persons'."""
    swap = ~F.col("is_person") | (F.col("person_2") & (F.col("sid_2") < F.col("sid")))
    kept = pairs.where((F.col("sid") != F.col("sid_2")) & (F.col("is_person") | F.col("person_2")))
    return kept.select(F.when(swap, F.col("sid_2")).otherwise(F.col("sid")).alias("sid_a"), F.when(swap, F.col("sid")).otherwise(F.col("sid_2")).alias("sid_b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's connected component, of edges ``a, b``.

    Labels spread to neighbours and jump to the labels of labels, until none changes.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("root").alias("further"))
        moved = materialize(step.join(up, "next").select("node", "old", F.least("next", "further").alias("root")), "labels")
        if not moved.where("old != root").head(1):
            return moved.select("node", "root")
        labels = moved.select("node", "root")


def linked(people: DataFrame, mentions: DataFrame, common: int = COMMON, pet_forms: str = PET_FORMS) -> tuple[DataFrame, DataFrame]:
    """(members, attached) from people ``id, name, g`` and mentions ``k1, k2, name, g``, one row per group g.

    members: ``node, root``, the ids of persons that have several, with the smallest of them.  Two
    ids are linked if names of theirs are spellings of one and share a group; links are followed
    through.  attached: ``k1, k2, id``: the person behind a mention, by the smallest id; of several
    persons the one whose name agrees best, then the smallest.  Null names and groups, and names
    without letters, link nothing; repeated rows count once.
    """
    spark = people.sparkSession
    rows = people.select(F.col("id").alias("k1"), F.lit(-1).alias("k2"), "name", "g").unionByName(mentions.select("k1", "k2", "name", "g"))
    rows = rows.where("name IS NOT NULL AND g IS NOT NULL AND k1 IS NOT NULL")
    entries = rows.mapInPandas(_spelled(Known(pet_forms)), "k1 long, k2 int, g long, tokens string, own double")
    # 128 bits identify a spelling
    sid = F.unhex(F.md5(F.concat_ws(" ", F.col("g").cast("string"), "tokens")))
    entries = materialize(entries.withColumn("sid", sid), "name-entries")
    spellings = entries.groupBy("sid", "g", "tokens").agg(F.min(F.when(F.col("k2") == -1, F.col("k1"))).alias("rep"), F.max("own").alias("own"))
    spellings = materialize(spellings, "spellings")
    known = spark.sparkContext.broadcast(Known(pet_forms, established(spellings)))
    pairs = candidate_pairs(spellings, known, common)
    for side in "ab":
        pairs = pairs.join(spellings.select(F.col("sid").alias(f"sid_{side}"), F.col("tokens").alias(f"tokens_{side}"), F.col("rep").alias(f"rep_{side}")), f"sid_{side}")
    strength = F.pandas_udf(_strength(known), "double")
    links = materialize(pairs.select("sid_a", "sid_b", "rep_a", "rep_b", strength("tokens_a", "tokens_b").alias("strength")).where("strength > 0"), "name-links")
    # an id stands beside the smallest id of its spelling, and the smallest ids of like spellings beside each other
    stars = entries.where("k2 = -1").select("sid", "k1").distinct().join(spellings.select("sid", "rep"), "sid").where("k1 != rep").select(F.col("rep").alias("a"), F.col("k1").alias("b"))
    members = components(stars.unionByName(links.where("rep_a != rep_b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))))
    options = spellings.where("rep IS NOT NULL").select("sid", "rep", F.col("own").alias("strength"))
    options = options.unionByName(links.select(F.col("sid_b").alias("sid"), F.col("rep_a").alias("rep"), "strength"))
    options = options.unionByName(links.where("rep_b IS NOT NULL").select(F.col("sid_a").alias("sid"), F.col("rep_b").alias("rep"), "strength"))
    named = options.join(members.select(F.col("node").alias("rep"), "root"), "rep", "left").select("sid", "strength", F.coalesce("root", "rep").alias("id"))
    best = F.max(F.struct("strength", (-F.col("id")).alias("low"))).alias("best")
    of_spelling = named.groupBy("sid").agg(best)
    of_mention = entries.where("k2 >= 0").select("sid", "k1", "k2").join(of_spelling, "sid").groupBy("k1", "k2").agg(F.max("best").alias("best"))
    return members, of_mention.select("k1", "k2", (-F.col("best.low")).alias("id"))


def link_names(people: DataFrame, mentions: DataFrame, common: int = COMMON, pet_forms: str = PET_FORMS) -> tuple[DataFrame, DataFrame]:
    """(persons, attached) as ``linked`` gives them, with persons as ``id_a, id_b`` (id_a < id_b): all pairs of ids of one person."""
    members, attached = linked(people, mentions, common, pet_forms)
    left, right = members.select("root", F.col("node").alias("id_a")), members.select("root", F.col("node").alias("id_b"))
    return left.join(right, "root").where("id_a < id_b").select("id_a", "id_b"), attached
