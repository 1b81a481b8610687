"""Personal information in free text: bootstrapped contextual extraction and typed placeholders.

Loose shapes propose candidates in one pass over the texts; a few of them are seeds (plain addresses of mail, numbers
with a country prefix, two published forms of identity numbers, streets with the plainest words, a handful of given
names). The words around a candidate are its lexical patterns, and what stands for it is its instance: the given name,
the mask of a number, the street word, the signs of a spelled-out mail address. Spark holds the graph of patterns and
instances with the number of times each pair occurs, and scores it in rounds: a pattern is as good as the instances in
it, an instance as good as the patterns it occurs in. Candidates are then joined with the scores by key, so no worker
holds the model, and those whose instance or pattern scores high are accepted. All documents take part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quartzflow.llm.texts import spread
from quartzflow.session import written

TYPES = ("email", "phone", "id_number", "address", "name")
ROUNDS = 4
SUPPORT = 2.0  # mentions of nothing that each score is diluted with
LEAST = 0.01  # patterns below this weigh nothing in the next round

# The seeds. Given names, street words, and nothing else that is a list.
SEED_NAMES = frozenset("JAMES JOHN THOMAS MARY ANNA SARAH HANS STEFAN PETRA URSULA JOSÉ JUAN MARÍA PILAR".split())
SEED_STREETS = frozenset(["n street", "n road", "s aße", "f calle"])
# Words that belong to a shape. Units, links within names of streets, titles, spelled signs.
EN_UNITS = "Flat|Apt|Apartment|Unit|Suite|Ste|Room|Rm|Floor"
ES_LINKS = "de la|de las|de los|del|de|la|las|los|el"
TITLES = frozenset("MR MRS MS MISS DR PROF SIR HERR FRAU SR SRA SRTA SEÑOR SEÑORA DON DOÑA".split())
AT_WORDS, DOT_WORDS = "at|ät|arroba|chez|bei", "dot|punkt|punto|point"

# ---- shapes ---------------------------------------------------------------------------------------------------------

# Signs may be spelled out: any short word in brackets, or one of a few bare words. A bare "at" needs a spelled dot.
_IN = r"\s?[\[({<]\s?\p{L}{1,12}\s?[\])}>]\s?"
_AT, _DOT = rf"(?:{_IN})", rf"(?:{_IN}|[ ](?:{DOT_WORDS})[ ])"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?"
_LOCAL = r"[\p{L}\p{N}](?:[\p{L}\p{N}._%+'-]*[\p{L}\p{N}_+-])?"
_TLD = r"\p{L}{2,}"
EMAIL = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}._%+*-])(?:{_LOCAL}@(?:{_LABEL}\.)+{_TLD}|{_LOCAL}(?:@|{_AT})(?:{_LABEL}(?:\.|{_DOT}))+{_TLD}|{_LOCAL}[ ](?:{AT_WORDS})[ ]{_LABEL}(?:\.{_LABEL})*{_DOT}(?:{_LABEL}{_DOT})*{_TLD})(?![\p{{L}}\p{{N}}@])", regex.I
)
_BRACKET = re.compile(r"[\[({<]\s?[^\W\d_]{1,12}\s?[\])}>]")
_BARE = [form for w in AT_WORDS.split("|") for form in (f" {w} ", f" {w.upper()} ", f" {w.capitalize()} ")]
_DOTS = [form for w in DOT_WORDS.split("|") for form in (f" {w} ", f" {w.upper()} ", f" {w.capitalize()} ")]
_SPELLED = regex.compile(rf"@|{_IN}|[ ](?:{AT_WORDS}|{DOT_WORDS})[ ]", regex.I)
_LOCAL_SIGNS = frozenset("._%+'-")

# The standard module is faster where no class of capitals is needed; [^\W_] is a letter or digit.
_NI = r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D](?![^\W_])"
_DNI = r"(?:\d{8}-?|\d{2}\.\d{3}\.\d{3}-?)[A-Z](?![^\W_])|[XYZ]-?\d{7}-?[A-Z](?![^\W_])"
_CODE = r"(?=[A-Z0-9]{7,12}(?![^\W_]))(?=[A-Z0-9]*[A-Z])(?:[A-Z]*\d){4,}[A-Z0-9]*"
_NUM = r"(?:\+|\()?\d[\d]*\)?(?:(?:[ ./-]|[ ]?\(|\)[ ]?|[ ]/[ ])\d+\)?)*"
NUMBER = re.compile(rf"(?=[\d(+A-Z][\d ()./A-Z-]{{5}})(?<![^\W_])(?<![.,+/…*:#-])(?:{_NI}|{_DNI}|{_CODE}|{_NUM})(?![^\W_]|…|[:,.-]\d)")
_PHONE_SEED = re.compile(r"\+\d[\d ()./-]{7,}")
# Published forms, one a language: national insurance, US social security, German tax number, Spanish identity number.
_ID_SEED = re.compile(rf"{_NI}|\d{{3}}-\d{{2}}-\d{{4}}|\d{{2}} \d{{3}} \d{{3}} \d{{3}}|\d{{8}}[A-Z]")
_NO_DIGIT = re.compile(r"\D+")
_DATE = regex.compile(r"(?:19|20)\d\d[-./](?:0?[1-9]|1[0-2])[-./]\d{1,2}|\d{1,2}[-./]\d{1,2}[-./](?:19|20)\d\d")

_CAP = r"\p{Lu}[\p{L}'’-]*"
_UNIT = rf"(?:{EN_UNITS})\.?[ ]#?\d+[A-Za-z]?"
_TOWN = rf"{_CAP}(?:[ ]{_CAP}){{0,2}}"
_UKPC = r"[A-Z]{1,2}\d{1,2}[A-Z]?[ ]\d[A-Z]{2}"
_USPC = r"[A-Z]{2}[ ]\d{5}(?:-\d{4})?"
# The number first: the last word is the kind of street.
NUMBER_FIRST = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}.:-])(?:{_UNIT},\s{{1,2}})?\d{{1,5}}[A-Za-z]?(?:[ ]{_CAP}){{1,3}}[ ](?P<kind>{_CAP})(?![\p{{L}}\p{{N}}])(?:\.(?=,))?(?:,?\s{{1,2}}{_UNIT}(?![\p{{L}}\p{{N}}]))?"
    rf"(?:,\s{{1,2}}{_TOWN}(?:,?\s{{1,2}}(?:{_UKPC}|{_USPC}))?(?![\p{{L}}\p{{N}}]))?"
)
_PLACE = rf"(?:,\s{{1,2}}\d{{5}}[ ]{_CAP}(?:[ ](?:(?:am|an der|im|ob der|{ES_LINKS})[ ])?{_CAP})?)?"
# The number last: the first of several words is the kind of street, or the end of a single word.
NUMBER_LAST = regex.compile(
    rf"(?<![\p{{L}}\p{{N}}])(?P<first>C/|{_CAP}\.?)(?P<more>[ ](?:(?:{ES_LINKS})[ ])*{_CAP}(?:[ ](?:(?:{ES_LINKS})[ ])*{_CAP}){{0,3}})?,?[ ](?:n\.?º[ ]?)?\d{{1,4}}(?:[ ]?[a-z](?![\p{{L}}\p{{N}}]))?(?![\p{{L}}\p{{N}}]|[.,:/-]\d|…)"
    rf"(?:,[ ]\d{{1,2}}\.?[ºª](?:[ ][A-Z](?![\p{{L}}\p{{N}}]))?)?{_PLACE}"
)
_THEN_WORD = re.compile(r"\d{1,5}[A-Za-z]?[ ](?=[^\W\d_])")
_UNIT_BEFORE = re.compile(rf"(?<![^\W_])(?:{EN_UNITS})\.?[ ]#?\d+[A-Za-z]?,\s{{1,2}}\Z")
_AFTER_BLANK = re.compile(r"(?<=[ ])\d{1,4}(?!\d)")
_UNITS = frozenset(EN_UNITS.lower().split("|"))
_LINKS = frozenset(w for link in ES_LINKS.split("|") for w in link.split())

_T = r"\p{Lu}[\p{L}'’-]*\p{L}"
_I = r"\p{Lu}\."
_P = r"(?:(?:de la|de los|de|del|von|van|van der|zu|da|di)[ ])?"
RUN = regex.compile(rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}@._*/-])(?:{_T}|{_I})(?:,?[ ]{_P}(?:{_T}|{_I}))+(?![\p{{L}}\p{{N}}@*_])")
PIECE = regex.compile(rf"({_P})({_T}|{_I})(,?)")
_NEXT = regex.compile(rf"[ ]({_P}{_T})(?![\p{{L}}\p{{N}}@*_])")
_LAST = regex.compile(rf"(?<![\p{{L}}\p{{N}}@._*/-])({_T})[ ]\Z")
_WORD = re.compile(r"[^\W\d_]+|\d+|\n|\S")
_LEADING_ZERO = re.compile(r"(?<!\d)0")
_MASK = str.maketrans("123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 9 + "A" * 26)


def mask(s: str) -> str:
    """The shape of a number: letters A, digits 0, a leading zero o."""
    return _LEADING_ZERO.sub("o", s).translate(_MASK)


def _plain(w: str) -> str:
    return "0" if w[0].isdigit() else w.lower()


def patterns(text: str, a: int, b: int) -> list[str]:
    """Lexical patterns of a place: what stands before, back to a word and two signs at least; two signs after; one on either side.

    Patterns without a letter say nothing and are left out. Words are never cut.
    """
    begin = max(0, a - 40)
    while begin and text[begin - 1].isalnum():
        begin -= 1
    left = _WORD.findall(text, begin, a)[-4:]
    k = len(left) - 2
    while k > 0 and not any(w[0].isalpha() for w in left[k:]):
        k -= 1
    left = [_plain(w) for w in left[max(0, k) :]]
    right = [_plain(m[0]) for m in islice(_WORD.finditer(text, b), 2)]
    out = []
    if any(w.isalpha() for w in left):
        out.append("l " + " ".join(left))
    if any(w.isalpha() for w in right):
        out.append("r " + " ".join(right))
    if left and right and (left[-1].isalpha() or right[0].isalpha()):
        out.append(f"b {left[-1]} {right[0]}")
    return out


# A candidate: kind, begin, end, instance, family, seed type, further family name and the span with it.
Candidate = tuple[str, int, int, str, str, "str | None", str, int, int]


def _places(text: str, s: str) -> Iterator[tuple[int, int]]:
    at = text.find(s)
    while at >= 0:
        yield at, at + len(s)
        at = text.find(s, at + max(1, len(s) - 1))


def _signs(text: str) -> list[tuple[int, int]]:
    """Places of what may be the sign of a mail address: the sign itself, a word in brackets, a bare word if a dot is spelled too."""
    out = list(_places(text, "@"))
    brackets = [m.span() for m in _BRACKET.finditer(text)]
    out += brackets
    if brackets or any(d in text for d in _DOTS):
        for w in _BARE:
            out += _places(text, w)
    return sorted(out)


def mails(text: str) -> Iterator[Candidate]:
    """Addresses of mail, looked for around each sign; the instance is how the signs are spelled."""
    last = 0
    for start, _ in _signs(text):
        a = start
        if a and text[a] != "@" and text[a - 1] == " ":
            a -= 1
        end = a
        while a > last and (text[a - 1].isalnum() or text[a - 1] in _LOCAL_SIGNS):
            a -= 1
        while a < end and not text[a].isalnum():
            a += 1
        if a < end and (found := EMAIL.match(text, a)) and found.end() > start:
            last = found.end()
            signs = " ".join(s[0].strip().lower() for s in _SPELLED.finditer(text, a, last))
            yield "email", a, last, signs, "", "email" if signs == "@" else None, "", a, last


def numbers(text: str) -> Iterator[Candidate]:
    for m in NUMBER.finditer(text):
        s = m[0]
        if len(s) < 6 or not 6 <= len(_NO_DIGIT.sub("", s)) <= 16 or _DATE.fullmatch(s) or s.count("(") != s.count(")"):
            continue
        a, b = m.span()
        seed = "id_number" if _ID_SEED.fullmatch(s) else "phone" if _PHONE_SEED.fullmatch(s) and sum(x.isdigit() for x in s) >= 9 else None
        yield "number", a, b, mask(s), "", seed, "", a, b


def _number_first(text: str) -> Iterator[regex.Match]:
    last = 0
    for m in _THEN_WORD.finditer(text):
        if m.start() >= last and text[m.end()].isupper():
            unit = _UNIT_BEFORE.search(text, max(last, m.start() - 24), m.start())
            if found := (unit and NUMBER_FIRST.match(text, unit.start())) or NUMBER_FIRST.match(text, m.start()):
                last = found.end()
                yield found


def _number_last(text: str) -> Iterator[regex.Match]:
    """Looked for at each short number after a word, from the earliest capitalised word that leads to it."""
    last = 0
    for m in _AFTER_BLANK.finditer(text):
        a = m.start() - 1
        if a <= last:
            continue
        if text[a - 1] == "º":  # the sign of a number stands between
            a = max(text.rfind(" ", last, a), last)
        starts: list[int] = []
        while a > last and text[a] == " " and len(starts) < 6:
            b = max(text.rfind(" ", last, a), text.rfind("\n", last, a), last - 1) + 1
            word = text[b:a]
            if word not in _LINKS:
                while b < a and not text[b].isalpha():
                    b += 1
                if b == a or not text[b].isupper():
                    break
                starts.append(b)
                if word[:1] != text[b]:  # something stands before the capital
                    break
            a = b - 1
        for b in reversed(starts):
            if (found := NUMBER_LAST.match(text, b)) and found.end() >= m.end():
                last = found.end()
                yield found
                break


def addresses(text: str) -> Iterator[Candidate]:
    """Numbers with capitalised words; the instance is the word that names the kind of street, and where it stands."""
    for m in _number_first(text):
        kind = "n " + m["kind"].lower()
        yield "address", *m.span(), kind, "", "address" if kind in SEED_STREETS else None, "", *m.span()
    for m in _number_last(text):
        first = m["first"].rstrip(".").lower()
        if not m["more"] and first in _UNITS:  # a unit alone
            continue
        kind = f"f {first}" if m["more"] else f"s {first[-3:]}"
        yield "address", *m.span(), kind, "", "address" if kind in SEED_STREETS else None, "", *m.span()


def names(text: str) -> Iterator[Candidate]:
    """Every reading of capitalised words as a given name, or its initial, with one family name, in either order."""
    for m in RUN.finditer(text):
        parts = [(p[2], p.start(2) if not p[1] else p.start(), p.end(2), bool(p[3])) for p in PIECE.finditer(text, *m.span())]
        n = len(parts)
        for i, (word, a, b, comma) in enumerate(parts):
            initial = word.endswith(".")
            # given [initial] family
            j = i
            while not parts[j][3] and j + 1 < n and j - i < 3:
                j += 1
                if not parts[j][0].endswith("."):
                    yield _name(text, a, parts[j][2], "" if initial else word.upper(), parts[j][0].upper(), False)
                    break
            # family, given
            if comma and not initial and i + 1 < n:
                w, _, end, _ = parts[i + 1]
                yield _name(text, a, end, "" if w.endswith(".") else w.upper(), word.upper(), True)


def _name(text: str, a: int, b: int, given: str, family: str, turned: bool) -> Candidate:
    """With the word beside the family name, which may be a second one."""
    seed = "name" if given in SEED_NAMES else None
    if turned:
        begin = max(0, a - 40)
        m = _LAST.search(text, begin, a)
        return ("name", a, b, given, family, seed, m[1].upper(), m.start(1), b) if m and (m.start(1) > begin or not begin) else ("name", a, b, given, family, seed, "", a, b)
    m = _NEXT.match(text, b)
    return ("name", a, b, given, family, seed, m[1].upper(), a, m.end()) if m else ("name", a, b, given, family, seed, "", a, b)


def candidates(text: str) -> Iterator[Candidate]:
    """All candidates of a text. What lies within a mail address is none, nor is a title a name."""
    found = list(mails(text))
    yield from found
    inside = [(c[1], c[2]) for c in found]
    for c in [*addresses(text), *numbers(text), *names(text)]:
        if c[0] == "name" and (c[3] in TITLES or c[4] in TITLES):
            continue
        if not inside or not any(a < c[2] and c[1] < b for a, b in inside):
            yield c


_FIELDS = "kind string, b int, e int, inst string, fam string, seed string, ext string, xb int, xe int, piece string, xpiece string, pats array<string>"
_ARROW = {"kind": pa.string(), "b": pa.int32(), "e": pa.int32(), "inst": pa.string(), "fam": pa.string(), "seed": pa.string(), "ext": pa.string(), "xb": pa.int32(), "xe": pa.int32(), "piece": pa.string(), "xpiece": pa.string(), "pats": pa.list_(pa.string())}
ROWS_AT_ONCE = 20_000


def found_candidates(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row a candidate: doc, h (hash of the text) and the fields. Written once; nothing later reads the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            cols: list[list] = [[] for _ in _ARROW]

            def full() -> pa.RecordBatch:
                index = pa.array(at, pa.int64())
                made = pa.RecordBatch.from_arrays([b.column("doc").take(index), b.column("h").take(index), *[pa.array(c, t) for c, t in zip(cols, _ARROW.values())]], names=["doc", "h", *_ARROW])
                at.clear()
                for c in cols:
                    c.clear()
                return made

            for j, t in enumerate(b.column("text").to_pylist()):
                for c in candidates(t):
                    at.append(j)
                    for col, v in zip(cols, (*c, t[c[1] : c[2]], t[c[7] : c[8]] if c[6] else None, patterns(t, c[1], c[2]))):
                        col.append(v)
                    if len(at) >= ROWS_AT_ONCE:
                        yield full()
            if at:
                yield full()

    src = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).filter("length(text) > 0")).select("doc", F.xxhash64("text").alias("h"), "text")
    return written(src.mapInArrow(run, f"doc {docs.schema[doc].dataType.simpleString()}, h bigint, {_FIELDS}"), "candidates")


# ---- the graph ------------------------------------------------------------------------------------------------------


def _typed(c: DataFrame) -> DataFrame:
    """A number is a candidate of both of its types."""
    two = F.array(F.lit("phone"), F.lit("id_number"))
    return c.withColumn("type", F.explode(F.when(F.col("kind") == "number", two).otherwise(F.array("kind"))))


def edges(found: DataFrame) -> DataFrame:
    """(type, pattern, instance, family, seed, n), summed over all documents; kinds and seeds collapse before the shuffle."""
    e = _typed(found).select("type", F.explode("pats").alias("pattern"), F.col("inst").alias("instance"), F.col("fam").alias("family"), F.coalesce(F.col("seed") == F.col("type"), F.lit(False)).alias("seed"))
    return e.groupBy("type", "pattern", "instance", "family", "seed").agg(F.count("*").alias("n"))


def learn(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Scores of patterns, instances and families: (kind, type, key, score).

    Each round a pattern scores the mean of its instances, diluted by SUPPORT, over what the patterns of the seeds'
    mentions score on average: few of the true instances are seeds, and what stands where seeds stand is as good as
    they are. An instance scores the mean, over its mentions, of their patterns, diluted alike. Seeds keep the score 1.
    An instance of several mentions is aggregated before any join, and patterns and instances are joined by key, so
    hot ones stay small.
    """
    graph = written(graph, "graph")
    # Families stand for initials, which say nothing by themselves.
    pairs = graph.select("type", "pattern", F.when(F.col("instance") == "", F.concat(F.lit("~"), "family")).otherwise(F.col("instance")).alias("instance"), "seed", "n")
    pairs = written(pairs.groupBy("type", "pattern", "instance").agg(F.sum("n").alias("n"), F.max("seed").alias("seed")), "pairs")
    instances = pairs.groupBy("type", "instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    scored = None
    for _ in range(rounds):
        rated = pairs.join(instances, ["type", "instance"])
        seeded = F.sum(F.when(F.col("seed"), F.col("n")).otherwise(0))
        raw = written(rated.groupBy("type", "pattern").agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + SUPPORT)).alias("p"), seeded.alias("seeded")), "raw")
        usual = raw.groupBy("type").agg(F.try_divide(F.sum(F.col("p") * F.col("seeded")), F.sum("seeded")).alias("usual"))  # a row a type
        scored = raw.join(F.broadcast(usual), "type").select("type", "pattern", F.least(F.lit(1.0), F.coalesce(F.try_divide("p", "usual"), F.lit(0.0))).alias("p"))
        scored = written(scored.filter(F.col("p") >= LEAST), "patterns")
        back = pairs.join(scored, ["type", "pattern"], "left")
        # An instance's mentions appear once for each of three patterns; the squares favour the telling ones.
        p = F.coalesce("p", F.lit(0.0))
        mean = F.sum(F.col("n") * p * p) / (F.sum(F.col("n") * p) + 0.5 * SUPPORT)
        spread_ = F.sum(F.col("n") * F.when(p >= 0.3, 1.0).otherwise(0.0)) / (F.sum("n") + SUPPORT)
        instances = back.groupBy("type", "instance").agg(F.max(F.col("seed").cast("double")).alias("seed"), (F.coalesce(mean, F.lit(0.0)) * F.least(F.lit(1.0), 3 * spread_)).alias("s")).select("type", "instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("s")).alias("score"))
        instances = written(instances, "instances")
    given = instances.filter("type = 'name' and instance not like '~%'")
    families = (
        graph.filter("type = 'name' and instance <> ''")
        .groupBy("instance", "family")
        .agg(F.sum("n").alias("n"))
        .join(given.select("instance", "score"), "instance")
        .groupBy("family")
        .agg(F.sum(F.col("n") * F.when(F.col("score") >= 0.4, F.col("score")).otherwise(0.0)).alias("s"), F.sum("n").alias("all"))
        # A second family name follows a family name, so a third of the mentions after given names is enough.
        .select("family", (F.col("s") / (F.col("s") + 0.5 * SUPPORT) * F.least(F.lit(1.0), 3 * F.col("s") / F.col("all"))).alias("score"))
    )
    parts = [
        scored.select(F.lit("pattern").alias("kind"), "type", F.col("pattern").alias("key"), F.col("p").alias("score")),
        instances.select(F.lit("instance").alias("kind"), "type", F.col("instance").alias("key"), "score"),
        families.select(F.lit("family").alias("kind"), F.lit("name").alias("type"), F.col("family").alias("key"), "score"),
    ]
    return written(parts[0].unionByName(parts[1]).unionByName(parts[2]), "scores")


# ---- extraction -----------------------------------------------------------------------------------------------------

_BASE = ("xb", "xe", "piece", "xpiece", "inst", "fam", "seed", "kind")


def rated(found: DataFrame, scores: DataFrame) -> DataFrame:
    """Each distinct candidate with the best score of its patterns and that of its instance, by type, and of its family names."""
    entry = lambda kind, type_, key: F.struct(F.lit(kind).alias("k"), type_.alias("type"), key.alias("key"))
    t, name = F.col("type"), F.lit("name")
    own = F.when((F.col("kind") == "name") & (F.col("inst") == ""), F.concat(F.lit("~"), "fam")).otherwise(F.col("inst"))
    keys = F.concat(
        F.transform("pats", lambda p: F.struct(F.lit("p").alias("k"), t.alias("type"), p.alias("key"))),
        F.array(entry("i", t, own)),
        F.when(F.col("kind") == "name", F.array(entry("f", name, F.col("fam")), entry("xf", name, F.col("ext")), entry("xi", name, F.col("ext")))).otherwise(F.array().cast("array<struct<k:string,type:string,key:string>>")),
    )
    slots = _typed(found).select("doc", "h", "b", "e", "kind", "inst", F.explode(keys).alias("x")).select("doc", "h", "b", "e", F.col("kind").alias("c"), F.col("inst").alias("ci"), "x.*")
    wanted = {"p": "pattern", "i": "instance", "f": "family", "xf": "family", "xi": "instance"}
    s = scores.filter(F.col("score") >= LEAST).select(F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("kind_")) for k, v in wanted.items()]), lambda w: w["kind_"] == F.col("kind"))).alias("w"), "type", "key", "score").select("w.k", "type", "key", "score")
    hits = slots.join(s, ["k", "type", "key"]).select("doc", "h", "b", "e", "c", "ci", "k", "type", "score", *[F.lit(None).cast(found.schema[n].dataType).alias(n) for n in _BASE])
    base = found.select("doc", "h", "b", "e", F.col("kind").alias("c"), F.col("inst").alias("ci"), F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("type"), F.lit(None).cast("double").alias("score"), *_BASE)
    best = lambda k, *types: F.coalesce(F.max(F.when((F.col("k") == k) & (F.col("type").isin(*types) if types else F.lit(True)), F.col("score"))), F.lit(0.0))
    return base.unionByName(hits).groupBy("doc", "h", "b", "e", "c", "ci").agg(
        *[F.max(n).alias(n) for n in _BASE],
        best("p").alias("p"),
        best("i").alias("i"),
        *[best(k, x).alias(f"{k}_{x}") for x in ("phone", "id_number") for k in ("p", "i")],
        *[best(k).alias(k) for k in ("f", "xf", "xi")],
    )


def _rank() -> tuple[Column, Column]:
    """Rank of a candidate, null if it is not accepted, and its type."""
    c, p, i, f = (F.col(x) for x in ("kind", "p", "i", "f"))
    seed = F.col("seed").isNotNull()
    number = lambda t: F.greatest(F.col(f"p_{t}"), F.when(F.col(f"i_{t}") >= 0.8, F.col(f"i_{t}")).otherwise(0.0))
    phone, ident = number("phone"), number("id_number")
    given = F.when(seed, 1.0).otherwise(i)
    initial = F.when(f >= 0.4, 0.5 + f).when(p >= 0.5, p)
    full = F.when((given >= 0.4) & ((f >= 0.3) | (p >= 0.3)), 1 + given + f).when((given >= 0.1) & (F.greatest(given, f) >= 0.3) & (p >= 0.75), p)
    rank = (
        F.when(c == "email", F.when(seed | (i >= 0.3) | (p >= 0.3), F.lit(9.0)))
        .when(c == "address", F.when(seed | (i >= 0.4) | ((p >= 0.7) & (i >= 0.1)), F.lit(8.0)))
        .when(c == "number", F.when(seed, 6.0).when(F.greatest(phone, ident) >= 0.5, 5 + F.greatest(phone, ident) / 2))
        .when(F.col("inst") == "", initial)
        .otherwise(full)
    )
    return rank, F.when(c != "number", c).when(seed, F.col("seed")).when(phone >= ident, "phone").otherwise("id_number")


def accepted(found: DataFrame, scores: DataFrame) -> DataFrame:
    """(doc, h, b, e, pii_type, piece): accepted candidates, none overlapping another of its text; the higher rank wins.

    Candidates are first cut into chains that overlap, so what is compared in one row is a chain, not a document.
    """
    rank, kind = _rank()
    # A second family name beside the first.
    two = (F.col("kind") == "name") & (F.col("xpiece").isNotNull()) & (F.col("xf") >= 0.2) & (F.col("xi") < F.col("xf"))
    r = rated(found, scores).withColumns({"rank": rank, "pii_type": kind}).filter("rank is not null")
    r = r.select("doc", "h", F.when(two, F.col("xb")).otherwise(F.col("b")).alias("b"), F.when(two, F.col("xe")).otherwise(F.col("e")).alias("e"), "rank", "pii_type", F.when(two, F.col("xpiece")).otherwise(F.col("piece")).alias("piece"))
    w = Window.partitionBy("doc", "h").orderBy("b", "e", "pii_type")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("chain", F.sum(F.when(reach.isNull() | (F.col("b") >= reach), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    item = F.struct((-F.col("rank")).alias("r"), "b", (-F.col("e")).alias("n"), "e", "pii_type", "piece")
    g = r.groupBy("doc", "h", "chain").agg(F.sort_array(F.collect_list(item)).alias("all"))
    none = F.array().cast(f"array<{g.schema['all'].dataType.elementType.simpleString()}>")
    taken = F.aggregate("all", none, lambda acc, x: F.when(F.exists(acc, lambda y: (y["b"] < x["e"]) & (x["b"] < y["e"])), acc).otherwise(F.concat(acc, F.array(x))))
    return g.select("doc", "h", F.explode(taken).alias("x")).select("doc", "h", "x.b", "x.e", "x.pii_type", "x.piece")


def _spans(docs: DataFrame, doc: str, text: str) -> DataFrame:
    found = found_candidates(docs, doc, text)
    return accepted(found, learn(edges(found)))


def personal_information(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pii_type, pii_text): each distinct piece of personal information of each document, as it stands there.

    Null and empty texts have none. The scores are learned from all of ``docs``. The pieces of rows of the same id are
    those of all its texts.
    """
    return _spans(docs, doc, text).select(F.col("doc").alias(doc), "pii_type", F.col("piece").alias("pii_text")).distinct()


def redacted(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, text, n_found): the texts with a placeholder such as [EMAIL] for each piece, otherwise unchanged.

    Null texts stay null. Every row comes out once.
    """
    at = _spans(docs, doc, text).groupBy("doc", "h").agg(F.sort_array(F.collect_list(F.struct("b", "e", "pii_type"))).alias("spans"))  # of one text
    d = docs.select(F.col(doc).alias("__doc"), F.col(text).alias("__text"), F.xxhash64(text).alias("__h"))
    j = d.join(at, F.col("__doc").eqNullSafe(F.col("doc")) & (F.col("__h") == F.col("h")), "left").select("__doc", "__text", F.coalesce("spans", F.array().cast(at.schema["spans"].dataType)).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, spans in zip(b.column("__text").to_pylist(), b.column("spans").to_pylist()):
                parts, at = [], 0
                for s in spans:
                    parts += [t[at : s["b"]], f"[{s['pii_type'].upper()}]"]
                    at = s["e"]
                texts.append(None if t is None else "".join(parts) + t[at:])
            yield pa.RecordBatch.from_arrays([b.column("__doc"), pa.array(texts, pa.string()), b.column("spans").value_lengths().cast(pa.int32())], names=["doc", "text", "n_found"])

    kind = docs.schema[doc].dataType.simpleString()
    return j.mapInArrow(run, f"doc {kind}, text string, n_found int").withColumnsRenamed({"doc": doc, "text": text})
