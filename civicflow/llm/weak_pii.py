"""Personal data by weak supervision; DataFrame operations only.

Regular expressions find base spans of four kinds, which always stay, and looser candidates: phone numbers without
a country code, e-mail addresses with a spelled-out "at", numbers written like cards that fail the checksum (kind
``account``), and literals that are assigned to a keyword such as "token" (kind ``secret``).  Six labelers
vote on each match from its pattern, a check of its digits, gazetteers, words before and around it,
and its edges.  Expectation-maximisation over the counts of vote patterns in the whole corpus
estimates how reliable each labeler is; its posteriors train a logistic regression, which
as a column expression decides which looser candidates are spans too.

A text's matches and the pieces between them (``regexp_extract_all`` and ``split`` by the same
pattern) give every position, so nothing leaves the row.  Only the vote patterns are shuffled,
at most 3**6 for each pattern that matches, and these counts are all the driver sees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "account", "secret")
# kind -> (pattern, cheap condition that every match fulfils).  Possessive and anchored at the start
# of a run where that can't change a match, so long runs cost no more than linear time.
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"text rlike '[0-9]\\.[0-9]++\\.[0-9]'"),
    "card": (r"[0-9](?:[\x20-]?+[0-9])++", r"text rlike '[0-9](?:[\\x20-]?+[0-9]){13}'"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
}
LOOSE = {
    "phone": (r"(?<![0-9+])(?<![0-9+)][\x20.(-]{1,3})\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![.-]?[0-9])",
              r"text rlike '[0-9]{3}[\\x20.-][0-9]{4}'"),
    "account": (r"(?<![0-9A-Za-z.+_-])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9A-Za-z_]|[.-][0-9])", r"text rlike '[0-9]{4}[\\x20-]?[0-9]{4}[\\x20-]?[0-9]{4}'"),
    "secret": (r"(?<=(?i:password|passwd|secret|token|api[_-]?key)[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?)(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{8,}+",
               r"text rlike '(?i)(?:password|passwd|secret|token|api[_-]?key)[\"\']?\\x20*[:=]'"),
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++",
              r"text rlike '[\\[(](?:at|AT)[\\])]'"),
}
LABELERS = ("pattern", "check", "gazetteer", "cue", "counter", "edges")
# Gazetteers and cue words, in alphabetical order.
TOP_LEVEL = ("at", "be", "br", "ca", "ch", "cn", "com", "de", "edu", "es", "eu", "fr", "gov", "in", "info", "io", "it", "jp", "mil", "net",
             "nl", "org", "pl", "pt", "ru", "se", "uk", "us")
ISSUERS = ("2[2-7]", "3[4-9]", "4", "5[0-8]", "6")
CODES = ("1", "2[07]", "3[0-469]", "4[013-9]", "5[1-8]", "6[0-6]", "7", "8[1246]", "9[0-58]")
STAND_INS = ("changeme", "example", "none", "null", "password", "placeholder", "xxxx", "your")
KEY_FORMS = ("^AKIA", "^[0-9a-f]{32,}$", "^gh[oprsu]_", "^[A-Za-z0-9+/]{40,}=*$")
CUES = {"email": "contact|e-?mail|mail|write to", "ip": "address|host|ip|peer|server", "card": "amex|card|credit|mastercard|pay|visa",
        "phone": "call|cell|fax|mobile|phone|tel|whatsapp", "account": "account|amex|card|credit|iban|mastercard|pay|visa",
        "secret": "auth|aws|bearer|config|credential|env|export|login|private"}
COUNTER = "chapter|invoice|isbn|issn|license|no\\.|order|part|ref|release|section|serial|sku|ticket|version"
BEFORE, AFTER = 40, 20
EM_ROUNDS = 25
SURE = 2.0    # log-odds that a looser candidate needs (88 per cent)
PRIOR = 20.0  # strength of the labelers' prior, in matches


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(pattern: str, condition: str, text: str = "text") -> Column:
    """All matches with the pieces around them: array of (value, gap, before, after); gap is the length
    of the piece since the last match."""
    p, none = _quoted(pattern), "cast(array() as array<struct<value:string,gap:int,before:string,after:string>>)"
    found = f"regexp_extract_all({text}, {p}, 0)"
    zipped = f"arrays_zip({found}, split({text}, {p}, -1), slice(split({text}, {p}, -1), 2, length({text}) + 1))"
    return F.expr(f"case when {condition} then transform(filter({zipped}, x -> x.`0` is not null), "
                  f"x -> struct(x.`0` as value, length(x.`1`) as gap, right(x.`1`, {BEFORE}) as before, left(x.`2`, {AFTER}) as after)) "
                  f"else {none} end")


def placed(hits: str) -> Column:
    """Adds start and end.  Running sums over blocks of about the square root of the number of matches,
    so thousands of matches in a text don't cost a quadratic sum."""
    lens = f"transform({hits}, x -> x.gap + length(x.value))"
    block = f"cast(ceil(sqrt(size({hits}))) as int)"
    total = lambda a: f"aggregate({a}, 0, (s, v) -> s + v)"
    blocks = f"transform(sequence(0, {block} - 1), b -> {total('slice(h.lens, b * h.block + 1, h.block)')})"
    upto = f"transform(sequence(0, h.block - 1), b -> {total('slice(h.sums, 1, b)')})"
    start = f"h.upto[cast(i div h.block as int)] + {total('slice(h.lens, cast(i div h.block as int) * h.block + 1, cast(i % h.block as int))')} + x.gap"
    one = f"transform({hits}, (x, i) -> struct({start} as start, {start} + length(x.value) as end, x.value as value, x.before as before, x.after as after))"
    # Each step hands its arrays to the next through a one-element transform, so they are computed once.
    step1 = f"array(struct({lens} as lens, {block} as block))"
    step2 = f"transform({step1}, h -> struct(h.lens as lens, h.block as block, {blocks.replace(block, 'h.block')} as sums))"
    step3 = f"transform({step2}, h -> struct(h.lens as lens, h.block as block, {upto} as upto))"
    return F.expr(f"case when size({hits}) > 0 then flatten(transform({step3}, h -> {one})) "
                  "else cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>) end")


def _luhn(digits: str) -> str:
    n = f"length({digits})"
    term = f"(cast(substr({digits}, i, 1) as int) * (1 + ({n} - i) % 2))"
    return f"aggregate(sequence(1, {n}), 0, (s, i) -> s + {term} - 9 * cast({term} > 9 as int)) % 10 = 0"


def _check(kind: str) -> str:
    """Whether a match of this kind passes, as SQL over x.value."""
    digits = "regexp_replace(x.value, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": "forall(split(x.value, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
        "card": f"length({digits}) between 14 and 19 and {_luhn(digits)}",
        "phone": f"length({digits}) between 10 and 15",
        "account": f"not ({_luhn(digits)}) and {digits} rlike '^(?:{'|'.join(ISSUERS)})'",
        "secret": f"length(x.value) >= 12 and x.value rlike '[0-9]' and x.value rlike '[A-Za-z]' and not lower(x.value) rlike '{'|'.join(STAND_INS)}'",
    }[kind]


def _gazetteer(kind: str) -> str:
    digits = "regexp_replace(x.value, '[^0-9]', '')"
    return {
        "email": f"case when lower(x.value) rlike '(?:[.]|[\\\\])]\\\\x20?)(?:{'|'.join(TOP_LEVEL)})$' then 1 else -1 end",
        "ip": "case when x.value rlike '^(?:0|127|255)[.]' then -1 else 0 end",
        "card": f"case when {digits} rlike '^(?:{'|'.join(ISSUERS)})' then 1 else -1 end",
        "account": f"case when {digits} rlike '(.)\\\\1{{4}}' then -1 else 0 end",
        "secret": f"case when x.value rlike '{'|'.join(KEY_FORMS)}' then 1 when x.value rlike '(.)\\\\1{{3}}' then -1 else 0 end",
        "phone": f"case when x.value rlike '^[+](?:{'|'.join(CODES)})' then 1 when x.value rlike '^[(]?[2-9]' then 1 else -1 end",
    }[kind]


def votes(kind: str, loose: bool) -> str:
    """The labelers' votes on x: 1 for, -1 against, 0 abstains; as one string of digits 2, 0 and 1."""
    cue = f"case when lower(x.before) rlike '\\\\b(?:{CUES[kind]})\\\\b' then 1 else 0 end"
    counter = f"case when lower(x.before) rlike '\\\\b(?:{COUNTER})[^\\\\n]{{0,12}}$' then -1 else 0 end"
    edges = "case when right(x.before, 1) rlike '[\\\\p{L}\\\\p{N}]' or left(x.after, 1) rlike '[\\\\p{L}\\\\p{N}]' then -1 else 1 end"
    each = ["0" if loose else "1", f"case when {_check(kind)} then 1 else -1 end", _gazetteer(kind), cue, counter, edges]
    return "concat(" + ", ".join(f"cast(pmod({v}, 3) as string)" for v in each) + ")"


def _vote(digit: str) -> int:
    return {"0": 0, "1": 1, "2": -1}[digit]


class Labels:
    """Vote-pattern counts {(pattern votes, source): n} -> labeler reliabilities and posteriors."""

    def __init__(self, counts: dict[str, int], rounds: int = EM_ROUNDS):
        # A labeler that votes is right four times in five, before any data; abstaining says nothing.
        self.like = [{y: {v: (0.4 if v == y else 0.1 if v else 0.5) for v in (-1, 0, 1)} for y in (-1, 1)} for _ in LABELERS]
        prior, self.share = self.like, 0.5
        for _ in range(rounds if counts else 0):
            mass = [{y: {v: PRIOR * prior[k][y][v] for v in (-1, 0, 1)} for y in (-1, 1)} for k in range(len(LABELERS))]
            yes, total = 1.0, 2.0
            for pattern, n in sorted(counts.items()):
                p = self.posterior(pattern)
                yes, total = yes + n * p, total + n
                for k, digit in enumerate(pattern):
                    mass[k][1][_vote(digit)] += n * p
                    mass[k][-1][_vote(digit)] += n * (1 - p)
            self.share = yes / total
            self.like = [{y: {v: mass[k][y][v] / sum(mass[k][y].values()) for v in (-1, 0, 1)} for y in (-1, 1)}
                         for k in range(len(LABELERS))]

    def posterior(self, pattern: str) -> float:
        odds = math.log(self.share) - math.log(1 - self.share)
        for k, digit in enumerate(pattern):
            odds += math.log(self.like[k][1][_vote(digit)]) - math.log(self.like[k][-1][_vote(digit)])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def train_classifier(counts: dict[str, int], labels: Labels, steps: int = 400, rate: float = 0.5, decay: float = 0.01) -> list[float]:
    """Logistic regression of the posteriors on the votes (bias first), weighted by the log of the counts,
    so frequent patterns don't drown the rare ones.  All patterns that could occur take part lightly."""
    rows = [([1.0, *map(float, map(_vote, p))], labels.posterior(p), math.log1p(n)) for p, n in sorted(counts.items())]
    for k in range(3 ** len(LABELERS)):
        p = "".join(str(k // 3 ** i % 3) for i in range(len(LABELERS)))
        rows.append(([1.0, *map(float, map(_vote, p))], labels.posterior(p), 0.02))
    weights, total = [0.0] * (len(LABELERS) + 1), sum(r[2] for r in rows)
    for _ in range(steps):
        grad = [decay * w for w in weights]
        for x, y, n in rows:
            e = (1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x)))) - y) * n / total
            for i, v in enumerate(x):
                grad[i] += e * v
        weights = [w - rate * g for w, g in zip(weights, grad)]
    return weights


def _score(pattern: str, weights: list[float]) -> str:
    """The classifier's log-odds as SQL over a vote pattern."""
    terms = [f"{weights[0]:.12f}D"]
    for i, w in enumerate(weights[1:], 1):
        terms.append(f"({w:.12f}D) * (case substr({pattern}, {i}, 1) when '1' then 1 when '2' then -1 else 0 end)")
    return " + ".join(terms)


def find_spans(docs: DataFrame) -> tuple[DataFrame, Labels, list[float]]:
    """(rows, labeler estimates, classifier weights); rows has doc_id, base and added, both arrays of
    (start, rank, end, kind, value) in order, end exclusive, in code points.

    NULL text is empty and has no spans; NULL and repeated doc_ids are carried through; equal texts
    get equal spans; other columns are ignored; an empty table gives no rows (and prior estimates).
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    raw = text.select("doc_id", *[matches(*BASE[k]).alias(f"base_{k}") for k in BASE],
                      *[matches(*LOOSE[k]).alias(f"loose_{k}") for k in LOOSE])
    hits = stored(raw, "pii-matches")
    at = hits.select("doc_id", *[placed(c).alias(c) for c in hits.columns if c != "doc_id"])
    judged = at.select("doc_id", *[
        F.expr(f"transform({c}, x -> struct(x.start as start, x.end as end, x.value as value, {_check(k)} as good, "
               f"{votes(k, c.startswith('loose'))} as votes))").alias(c)
        for c in at.columns if c != "doc_id" for k in [c.split("_")[1]]])
    judged = stored(judged, "pii-votes")
    patterns = judged.select(F.explode(F.flatten(F.array(*[F.expr(f"transform({c}, x -> x.votes)") for c in judged.columns if c != "doc_id"]))).alias("votes"))
    counts = {r.votes: r.n for r in patterns.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    labels = Labels(counts)
    weights = train_classifier(counts, labels)
    span = lambda k: f"x -> struct(x.start as start, {ALL_KINDS.index(k)} as rank, x.end as end, '{k}' as kind, x.value as value)"
    base = F.array_sort(F.concat(*[F.expr(f"transform(filter(base_{k}, x -> x.good), {span(k)})") for k in BASE]))
    picked = F.concat(*[F.expr(f"transform(filter(loose_{k}, x -> x.good and {_score('x.votes', weights)} > {SURE}D), {span(k)})") for k in LOOSE])
    rows = judged.select("doc_id", base.alias("base"), picked.alias("picked"))
    free = F.expr("filter(picked, c -> not exists(base, b -> b.start < c.end and c.start < b.end))")
    return rows.select("doc_id", "base", F.array_sort(free).alias("added")), labels, weights


def spelled(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")
