r"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans follow fixed patterns (email, ip, card, phone; see BASE) and always stay. Candidates for more spans are
what a base pattern matched and its strict check refused (a card number with a wrong checksum, an address with a part
over 255, a phone number of too few digits) and what wider patterns find: spelled-out addresses (``name (at) host
dot com``), phone numbers in national form, social-security numbers, colon-separated addresses. Every candidate, base
spans among them, is voted on by labelers of three sorts: patterns (is the shape canonical, is the checksum right,
is the length plausible), gazetteers (domain endings, file endings, reserved ranges, issuers, calling codes) and context
(does a cue word, or a word that speaks against, stand before the span; does a longer word go on around it). A labeler
says yes, no or nothing.

Votes are counted by pattern over the whole corpus, at most 3^labelers rows for a kind whatever the input, and
expectation-maximisation over these counts estimates each labeler's reliability and the share of true spans
per kind (a two-class latent model with conditionally independent votes). Its posteriors are then the soft
labels of a final classifier, a logistic model on the votes for each kind, fitted on the same counts. Candidates that it
gives at least ``threshold`` are added; the others are left out, and so are those that overlap a base span.

Patterns run as DataFrame functions: all matches and the pieces between them come from one regular expression,
and positions are running sums of their lengths, made by doubling. Quantifiers are possessive and starts are anchored
behind other characters of the same class, so long runs stay linear, and a text of n matches costs n log n.

Edge cases: a null or empty text has no spans; ids may be null or repeat, since spans are found, decided and
redacted within a row; other columns are ignored by :func:`detect` and :func:`digests` and kept by :func:`redact`,
whatever their names; an empty table gives an empty result, and without candidates EM keeps its priors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_if_null, let, named, stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: The base patterns, equal to the contract's: `\G` lets a match begin right behind the one before. A card's match is a whole
#: run of digits, so one of under 12 digits, which could only fail, isn't asked for.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried.
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Wider patterns for candidates, by the kind they would add.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?)[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Za-z:])",
    "card": r"(?<![0-9+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])|(?<![0-9+])00[1-9][0-9\x20-]{8,16}[0-9](?![0-9])",
}
#: Gazetteers and cue words of our own.
DOMAIN_ENDINGS = ("com", "net", "org", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca")
FILE_ENDINGS = ("png", "jpg", "gif", "svg", "css", "js", "json", "py", "java", "txt", "html", "local", "localhost", "invalid", "test")
_BEHIND = r"\b\W{0,3}(?:\w{1,3}\W{0,3})?$"  # at most one short word between the cue and the span
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|reach|courriel|correo|kontakt)" + _BEHIND,
    "ip": r"(?i)\b(?:ip|address|host|server|from|login|gateway|dns|client)" + _BEHIND,
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|ssn|social security|carte|tarjeta|karte)" + _BEHIND,
    "phone": r"(?i)\b(?:phone|telephone|tel|call|mobile|cell|fax|dial|ring|telefon|handy|tél|teléfono)" + _BEHIND,
}
DOUBTS = {
    "email": r"(?i)\b(?:meet|look|arrive|laugh|good|version|file|path|image|class|import)" + _BEHIND,
    "ip": r"(?i)\b(?:version|release|build|section|chapter|figure|v|ver|rev|oid)" + _BEHIND,
    "card": r"(?i)\b(?:isbn|serial|invoice|order|tracking|ticket|batch|part|checksum|id|ref|item|barcode)" + _BEHIND,
    "phone": r"(?i)\b(?:isbn|serial|invoice|order|tracking|ticket|batch|part|score|range|ref|item|model|offset)" + _BEHIND,
}
LABELERS = ("canonical", "check", "plausible", "gazetteer", "cue", "alone")
THRESHOLD = 0.8


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Is the checksum of a string of digits right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.try_element_at(F.array(*[F.lit(x) for x in range(10)]), d.cast("int") + 1) * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(each, F.lit(0), lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    digits = _digits(s)
    n = F.length(digits)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.lpad(F.regexp_replace(p, "^0+", ""), 3, "0") <= "255")
        return F.forall(F.split(s, r"\."), small)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits)).otherwise(False)
    return n.between(9, 15)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The array's running joins (sums, maxima), by doubling: a fold that appends would copy the array for each element."""
    rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int") - 1, F.lit(0)))
    back = lambda i, r: i - F.call_function("shiftleft", F.lit(1), r)
    return F.aggregate(rounds, values, lambda acc, r: F.transform(acc, lambda x, i: F.when(back(i, r) >= 0, join(x, F.get(acc, back(i, r)))).otherwise(x)))


def _located(text: Column, pattern: str, hint: str | None, build: Callable[[Column], Column]) -> Column:
    """Array of build((m, start, before, after)) for all matches, left to right."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def placed(m: Column, p: Column) -> Column:
        ends = _running(F.transform(m, lambda x, i: F.coalesce(F.length(F.get(p, i)) + F.length(x), F.lit(0))), lambda x, y: x + y)
        one = lambda e: lambda x, i: F.struct(
            x.alias("m"), (F.get(e, i) - F.length(x)).alias("start"), F.right(F.get(p, i), F.lit(40)).alias("before"), F.left(F.get(p, i + 1), F.lit(20)).alias("after")
        )
        return F.transform(let(ends, lambda e: F.transform(m, one(e))), build)

    none = F.array().cast("array<struct<kind:string,no:int,start:int,stop:int,base:boolean,votes:string>>")
    test = (F.instr(text, hint) > 0) if hint else F.regexp_like(text, F.lit("[0-9]"))
    return F.when(test & F.regexp_like(text, F.lit(pattern)), let(found, lambda m: let(pieces, lambda p: placed(m, p)))).otherwise(none)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("y")).when(no, F.lit("n")).otherwise(F.lit("-"))


def _votes(kind: str, span: Column, strict: bool) -> Column:
    """The labelers' votes as a string of y, n and -, in the order of LABELERS.

    strict: the span is a base pattern's. What a wider pattern vouches for by itself gets no vote.
    """
    s, before, after = span["m"], span["before"], span["after"]
    digits = _digits(s)
    n = F.length(digits)
    ending = F.lower(F.regexp_extract(s, r"([A-Za-z]+)$", 1))
    valid = _valid(kind, s)
    canonical = _vote(valid, F.lit(True)) if strict else F.lit("-")
    if kind == "email":
        check = _vote(F.regexp_like(s, F.lit(r"(?i)[a-z]{2,}$")), F.lit(True)) if strict else F.lit("-")
        plausible = _vote(F.length(s).between(6, 80), F.length(s) > 120)
        gazetteer = _vote(ending.isin(*DOMAIN_ENDINGS), ending.isin(*FILE_ENDINGS) | (F.length(ending) < 2))
    elif kind == "ip":
        check = _vote(valid, F.lit(True)) if strict else F.lit("-")
        plausible = _vote(~F.regexp_like(s, F.lit(r"(?:^|[.:])0[0-9]")) & (F.length(s) > 9), F.length(s) < 9)
        gazetteer = _vote(F.regexp_like(s, F.lit(r"^(?:10|172|192|8|2001|fe80|fd[0-9a-f]{2})[.:]")), F.regexp_like(s, F.lit(r"^(?:127|255|0)\.")))
    elif kind == "card":
        check = F.when(n.between(12, 19), _vote(luhn(digits), F.lit(True))).otherwise(F.lit("n")) if strict else F.lit("-")
        plausible = _vote(n.isin(9, 15, 16), (n > 19) | F.regexp_like(digits, F.lit(r"([0-9])\1{5}")))
        gazetteer = _vote(F.regexp_like(digits, F.lit(r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")), F.regexp_like(digits, F.lit("^(?:0|9)")))
    else:
        check = _vote(n.between(9, 15), F.lit(True)) if strict else F.lit("-")
        plausible = _vote(n.between(10, 13), (n < 8) | F.regexp_like(digits, F.lit(r"([0-9])\1{6}")))
        gazetteer = _vote(F.regexp_like(s, F.lit(r"^(?:\+|00)(?:1|3[0-9]|4[0-9]|7)|^\(?[2-9][0-9]{2}[).-]")), F.regexp_like(digits, F.lit("^(?:000|999)")))
    cue = _vote(F.regexp_like(before, F.lit(CUES[kind])), F.regexp_like(before, F.lit(DOUBTS[kind])))
    open_ = F.regexp_like(F.concat(F.lit(" "), before), F.lit(r"[\s(\[\"':;,<>=]$"))
    closed = F.regexp_like(F.concat(after, F.lit(" ")), F.lit(r"^[\s)\]\"':;,.!?<>]"))
    alone = _vote(open_ & closed, F.regexp_like(before, F.lit("[0-9A-Za-z#/_-]$")) | F.regexp_like(after, F.lit("^[0-9A-Za-z#/_-]")))
    return F.concat(canonical, check, plausible, gazetteer, cue, alone)


def candidates(text: Column) -> Column:
    """Array of (start, no, stop, kind, base, votes) of a text's base spans and the candidates that overlap none, sorted."""
    parts = []
    for no, kind in enumerate(KINDS):

        def build(strict: bool, kind: str = kind, no: int = no):
            return lambda x: F.struct(
                F.lit(kind).alias("kind"), F.lit(no).alias("no"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("stop"),
                (_valid(kind, x["m"]) if strict else F.lit(False)).alias("base"), _votes(kind, x, strict).alias("votes"),
            )

        parts.append(_located(text, BASE[kind], _HINT[kind], build(True)))
        parts.append(_located(text, WIDE[kind], {"email": "at", "ip": ":"}.get(kind), build(False)))
    return let(F.sort_array(F.transform(F.concat(*parts), lambda s: F.struct(s["start"], s["no"], s["stop"], s["kind"], s["base"], s["votes"]))), _free)


def _free(e: Column) -> Column:
    """Sorted spans without those that overlap a base span and are none."""
    reach = _running(F.transform(e, lambda s: F.when(s["base"], s["stop"]).otherwise(0)), lambda x, y: F.greatest(x, y))
    ahead = F.reverse(_running(F.reverse(F.transform(e, lambda s: F.when(s["base"], s["start"]).otherwise(2**31 - 1))), lambda x, y: F.least(x, y)))
    clear = lambda s, i, r, a: (F.coalesce(F.get(r, i - 1), F.lit(0)) <= s["start"]) & (F.coalesce(F.get(a, i + 1), F.lit(2**31 - 1)) >= s["stop"])
    left = let(reach, lambda r: let(ahead, lambda a: F.filter(e, lambda s, i: s["base"] | clear(s, i, r, a))))
    return F.when(F.forall(e, lambda s: s["base"]), e).otherwise(left)


def fit(tallies: list[tuple[str, str, int]], rounds: int = 60) -> dict[tuple[str, str], float]:
    """{(kind, votes): probability} from the counts of each kind's vote patterns, one model for each kind."""
    kinds = sorted({k for k, _, _ in tallies})
    return {(kind, v): p for kind in kinds for v, p in _fit_kind([(v, c) for k, v, c in tallies if k == kind], rounds).items()}


def _fit_kind(counts: list[tuple[str, int]], rounds: int) -> dict[str, float]:
    """EM, then a logistic model on the votes, fitted to EM's posteriors by gradient steps.

    EM has the share of true spans and, for each labeler that votes, how often it says yes to true and to false
    ones. Yes is never rarer among true ones, so that the classes keep their meaning; a labeler that says yes to
    both alike counts nothing. EM begins with objections worth more than consents, and pseudo-counts of ten votes hold a
    labeler near there where there is little to see.
    """
    share, yes = 0.5, [{True: 0.9, False: 0.5} for _ in LABELERS]
    total = sum(c for _, c in counts)
    post: dict[str, float] = {}

    def chance(votes: str) -> float:
        logit = math.log(share / (1 - share))
        for rate, v in zip(yes, votes, strict=True):
            if v != "-":
                logit += math.log(rate[True] / rate[False]) if v == "y" else math.log((1 - rate[True]) / (1 - rate[False]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))

    for _ in range(rounds):
        post = {v: chance(v) for v, _ in counts}
        share = min(0.99, max(0.01, (sum(c * post[v] for v, c in counts) + 2) / (total + 4)))
        for i, rate in enumerate(yes):
            voted = [(v[i] == "y", c * post[v], c * (1 - post[v])) for v, c in counts if v[i] != "-"]
            up = [sum(t for y, t, _ in voted if y) + 9, sum(t for _, t, _ in voted) + 10]
            down = [sum(f for y, _, f in voted if y) + 5, sum(f for _, _, f in voted) + 10]
            if up[0] * down[1] < down[0] * up[1]:
                up = down = [up[0] + down[0], up[1] + down[1]]
            rate[True], rate[False] = (min(0.98, max(0.02, x[0] / x[1])) for x in (up, down))
    features = {v: [1.0] + [1.0 if x == "y" else -1.0 if x == "n" else 0.0 for x in v] for v, _ in counts}
    weights = [0.0] * (len(LABELERS) + 1)
    said = lambda v: 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * f for w, f in zip(weights, features[v], strict=True))))))
    mass = sum(math.log1p(c) for _, c in counts)
    for _ in range(800):
        off = [(v, math.log1p(c) * (post[v] - said(v)) / mass) for v, c in counts]
        weights = [w + 2.0 * sum(o * features[v][i] for v, o in off) for i, w in enumerate(weights)]
    return {v: said(v) for v, _ in counts}


def _sure(found: DataFrame, threshold: float) -> list[str]:
    """Kinds and vote patterns that the classifier accepts, learned from all candidates in the column `all`."""
    tally = found.select(F.explode("all").alias("s")).groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes")).count()
    counts = [(r["kind"], r["votes"], r["count"]) for r in tally.collect()]  # 4 * 3^6 rows at most
    return sorted(f"{k}:{v}" for (k, v), p in fit(sorted(counts)).items() if p >= threshold)


def _decided(found: Column, sure: list[str]) -> Column:
    """Base spans and accepted candidates."""
    chosen = F.array(*[F.lit(a) for a in sure]) if sure else F.array().cast("array<string>")
    return F.filter(found, lambda s: s["base"] | F.array_contains(chosen, F.concat_ws(":", s["kind"], s["votes"])))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: id, spans (array of start, no, stop, kind, base, votes) by start, then kind."""
    found = stored(docs.select(named(id_col).alias("id"), candidates(blank_if_null(text_col)).alias("all")), "candidates")
    return found.select(F.col("id").alias(id_col), _decided(F.col("all"), _sure(found, threshold)).alias("spans"))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: id, counts of base spans by kind, base_sha256, spans."""
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return detect(docs, id_col, text_col, threshold).select(named(id_col), *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


_BLOCK = 4096


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans go as one, by the first one's kind.

    Parts are cut from blocks of the text, since a cut counts characters from the beginning of what it cuts.
    """
    reach = _running(F.transform(spans, lambda s: s["stop"]), lambda x, y: F.greatest(x, y))
    head = lambda s, i, r: (i == 0) | (s["start"] >= F.get(r, i - 1))
    firsts = lambda e, r: F.filter(F.transform(e, lambda s, i: F.when(head(s, i, r), F.struct(i.alias("i"), s["start"].alias("start"), s["kind"].alias("kind")))), lambda h: h.isNotNull())
    ends = lambda h, r: F.transform(h, lambda x, k: F.get(r, F.coalesce(F.get(h, k + 1)["i"], F.size(r)) - 1))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}+"), F.lit(0))

    def part(b: Column, start: Column, stop: Column) -> Column:
        first = F.floor(start / _BLOCK).cast("int")
        touched = F.slice(b, first + 1, F.greatest(F.ceil(stop / _BLOCK).cast("int") - first, F.lit(0)))
        return F.array_join(F.transform(touched, lambda x, k: F.substring(x, F.greatest(start - (first + k) * _BLOCK, F.lit(0)) + 1, stop - F.greatest(start, (first + k) * _BLOCK))), "")

    def whole(h: Column, z: Column, b: Column) -> Column:
        parts = F.transform(h, lambda x, k: F.concat(part(b, F.coalesce(F.get(z, k - 1), F.lit(0)), x["start"]), F.lit("<"), x["kind"], F.lit(">")))
        return F.concat(F.array_join(parts, ""), part(b, F.get(z, F.size(z) - 1), F.length(text)))

    cut = let(reach, lambda r: let(firsts(spans, r), lambda h: let(ends(h, r), lambda z: let(blocks, lambda b: whole(h, z, b)))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the text's spans redacted, row by row; all columns kept."""
    sure = _sure(docs.select(candidates(blank_if_null(text_col)).alias("all")), threshold)
    spans = _decided(candidates(blank_if_null(text_col)), sure)
    text = named(text_col)
    done = F.when(text.isNotNull(), let(spans, lambda e: redacted(text, e)))
    return docs.select(*[done.alias(c) if c == text_col else named(c) for c in docs.columns])
