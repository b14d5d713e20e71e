"""Personal data: base patterns, and candidates chosen by gradient-boosted trees.

Native: DataFrame functions only. Base spans (email, ip, card, phone) come from fixed
patterns and checks. Generators of high recall propose further, overlapping candidates
(looser addresses, telephone-like and account-like numbers, key-like strings). Each has
binned features of its format and of the text around it. Boosted trees of depth two,
fitted on all documents, score them; per kind the least score that keeps a precision
of PRECISION on held-out documents is the threshold. Chosen candidates that no base span overlaps
are added.

No labelled spans exist. Training rewrites the texts: base addresses are
obfuscated, `name (at) host`, and base telephone numbers lose their + and country code.
Candidates at these places are positive, and so are strings assigned to a word for a
credential and number-like ones that pass a base check; all others are negative. So trees
learn forms that no base pattern has. Trees are fitted on the candidates of two thirds of
all documents, told apart by a hash of the text, and the thresholds are set on the rest
(where it has a positive of the kind), whose recall is kept. Only the counts of distinct
feature vectors reach the driver, a number bounded by the bins.

All steps are linear in a text's length, or n log n in its matches, so that very long
texts are read whole. Offsets are code points, end exclusive. A null text is empty.
Repeated rows are each returned; nothing depends on order; extra columns are ignored; an
empty table gives an empty one, and trees that choose nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliowright.functions.text import bound, running_greatest, running_sums

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("email_like", "phone_like", "number_like", "secret")
KINDS = BASE_KINDS + MORE_KINDS
PRECISION, ROUNDS, RATE = 0.9, 30, 0.3

# A match found from the left starts a run of its first class or where the last match
# ended, so that no other start needs a try; no part ever has to give back what it took.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MORE = {
    "email_like": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "phone_like": r"(?:\G|(?<![0-9+]))[+(]?[0-9][0-9().-]*+(?:\x20[(0-9][0-9().-]*+){0,5}+",
    "number_like": r"(?:\G|(?<![0-9A-Za-z]))[0-9]++(?:[\x20.-]?[0-9]++)*+",
    "secret": r"(?:\G|(?<![A-Za-z0-9_/+-]))[A-Za-z0-9_/+-]{16,}+",
}
_GUARD = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "email_like": r"@|[(\[]at[)\]]", "phone_like": r"[0-9]", "number_like": r"[0-9]{2}", "secret": r"[A-Za-z0-9_/+-]{16}"}
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_CUE = r"(?i)(?:token|secret|password|passwd|key|card|account|call|phone|tel|mail|contact|ip|host)\W{0,4}$"
_ASSIGNED = r"(?i)(?:token|secret|password|passwd|key)\x20?[=:]\x20?[\"']?$"

#: Set before what a training text is rewritten at; a character of no width that texts are rid of first.
_MARK = "\u2060"

#: Features by name and the number of their bins.
FEATURES = {"gen": 4, "size": 6, "digits": 7, "seps": 4, "letters": 3, "plus": 2, "at": 2, "cue": 2, "assigned": 3, "upper": 3, "dots": 3, "round": 2, "at_word": 2}


def located(text: Column, pattern: str, guard: str) -> Column:
    """Matches of the pattern from the left: start, end, s, before and after, as an array."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    # the text before and behind each match; nothing here is computed anew for each match
    sides = F.zip_with(
        F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts) - 1),
        lambda p, q: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(24)).alias("before"), F.left(q, F.lit(2)).alias("after")),
    )
    both = F.zip_with(sides, found, lambda g, s: F.struct(g["gap"].alias("gap"), F.length(s).alias("n"), s.alias("s"), g["before"].alias("before"), g["after"].alias("after")))
    kind = "array<struct<start:int,end:int,s:string,before:string,after:string>>"

    def placed(matches: Column) -> Column:
        def one(m: Column, end: Column) -> Column:
            return F.struct((end - m["n"]).cast("int").alias("start"), end.cast("int").alias("end"), m["s"].alias("s"), m["before"].alias("before"), m["after"].alias("after"))

        return F.zip_with(matches, running_sums(F.transform(matches, lambda m: m["gap"] + m["n"])), one)

    return F.when(text.rlike(guard), bound(both, placed).cast(kind)).otherwise(F.array().cast(kind))


def luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda acc, v: acc + v) % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def passes(kind: str, s: Column) -> Column:
    """The check of a base kind on a match."""
    if kind == "ip":
        return s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(s)).between(14, 19), luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(s)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    def checked(kind: str) -> Column:
        return F.filter(located(text, _BASE[kind], _GUARD[kind]), lambda m: passes(kind, m["s"]))

    return {k: checked(k) for k in BASE_KINDS}


def _binned(value: Column, *steps: int) -> Column:
    """How many of the steps the value reaches."""
    out = F.lit(0)
    for s in steps:
        out = out + (value >= s).cast("int")
    return out


def candidates(text: Column) -> Column:
    """All generators' proposals with their features, and weak labels, as an array."""

    def dressed(kind: str, m: Column) -> Column:
        s, n = m["s"], F.length(m["s"])
        digits, letters = F.length(_digits(s)), F.length(F.regexp_replace(s, "[^A-Za-z]+", ""))
        upper = F.length(F.regexp_replace(s, "[^A-Z]+", ""))
        label = {
            "email_like": m["before"].endswith(_MARK),
            "phone_like": m["before"].endswith(_MARK),
            "number_like": F.when(digits.between(14, 19), luhn(_digits(s))).otherwise(False) | s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
            "secret": m["before"].rlike(_ASSIGNED) | s.rlike("^AKIA[A-Z0-9]{16}$"),
        }[kind]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.lit(MORE_KINDS.index(kind)).alias("gen"), _binned(n, 8, 12, 16, 20, 32).alias("size"), _binned(digits, 1, 5, 10, 14, 17, 20).alias("digits"),
            _binned(F.length(F.regexp_replace(s, "[A-Za-z0-9]+", "")), 1, 3, 5).alias("seps"), F.when(letters == 0, 0).when(digits > 0, 1).otherwise(2).alias("letters"),
            s.contains("+").cast("int").alias("plus"), s.contains("@").cast("int").alias("at"), m["before"].rlike(_CUE).cast("int").alias("cue"),
            F.when(m["before"].rlike(_ASSIGNED), 2).when(m["before"].rlike("[=:\"']$"), 1).otherwise(0).alias("assigned"),
            F.when(upper == 0, 0).when(upper < letters, 1).otherwise(2).alias("upper"), _binned(n - F.length(F.replace(s, F.lit("."))), 1, 3).alias("dots"),
            s.contains("(").cast("int").alias("round"), s.rlike(r"[(\[]at[)\]]").cast("int").alias("at_word"),
            label.cast("int").alias("label"),
        )

    def proposed(kind: str) -> Column:
        long = F.filter(located(text, _MORE[kind], _GUARD[kind]), lambda m: m["end"] - m["start"] >= 7)
        return F.transform(long, lambda m: dressed(kind, m))

    return F.flatten(F.array(*[proposed(k) for k in MORE_KINDS]))


class Trees:
    """Boosted trees of depth two over binned features, and a threshold for each kind."""

    def __init__(self, rows: list[tuple], held_out: list[tuple], rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION):
        """rows: (features..., positives, negatives) of distinct feature vectors; held_out: the same of others, for thresholds and recall."""
        self.names, self.trees = list(FEATURES), []
        data = [(r[:-2], float(r[-2]), float(r[-1])) for r in rows]
        total = sum(p + n for _, p, n in data)
        pos = sum(p for _, p, _ in data)
        self.bias = math.log((pos + 0.5) / (total - pos + 0.5))
        margin = [self.bias] * len(data)
        for _ in range(rounds if data else 0):
            g, h = [], []
            for (_, p, n), m in zip(data, margin):
                q = 1 / (1 + math.exp(-m))
                g.append(p * (1 - q) - n * q)
                h.append((p + n) * q * (1 - q))
            tree = self._grow([x for x, _, _ in data], g, h, range(len(data)), 2, rate)
            self.trees.append(tree)
            margin = [m + self._value(tree, x) for (x, _, _), m in zip(data, margin)]
        told = [(r[0], self.bias + sum(self._value(tree, r[:-2]) for tree in self.trees), float(r[-2]), float(r[-1])) for r in held_out]
        fitted = [(x[0], m, p, n) for (x, p, n), m in zip(data, margin)]
        self.thresholds = {}
        for k in range(len(MORE_KINDS)):
            own = [x[1:] for x in told if x[0] == k]
            # few documents may hold out no positive of a kind
            self.thresholds[k] = self._threshold(own if sum(x[1] for x in own) else [x[1:] for x in fitted if x[0] == k], precision)
        #: share of held-out positives that are chosen, by kind; None where there are none
        self.recall = {}
        for k, name in enumerate(MORE_KINDS):
            every = sum(p for kind, _, p, _ in told if kind == k)
            self.recall[name] = sum(p for kind, m, p, _ in told if kind == k and m >= self.thresholds[k] - 1e-9) / every if every else None

    def _grow(self, xs, g, h, own, depth, rate):
        own = list(own)
        gs, hs = sum(g[i] for i in own), sum(h[i] for i in own)
        leaf, best = rate * gs / (hs + 1), None
        if depth:
            for f, bins in enumerate(FEATURES.values()):
                by = [[0.0, 0.0] for _ in range(bins)]
                for i in own:
                    by[xs[i][f]][0] += g[i]
                    by[xs[i][f]][1] += h[i]
                gl = hl = 0.0
                for cut in range(bins - 1):
                    gl, hl = gl + by[cut][0], hl + by[cut][1]
                    gain = gl * gl / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs * gs / (hs + 1)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, f, cut)
        if best is None:
            return leaf
        _, f, cut = best
        return (f, cut, self._grow(xs, g, h, [i for i in own if xs[i][f] <= cut], depth - 1, rate), self._grow(xs, g, h, [i for i in own if xs[i][f] > cut], depth - 1, rate))

    def _value(self, tree, x) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    @staticmethod
    def _threshold(rows: list[tuple], precision: float) -> float:
        """The least margin from which on the share of positives is at least the precision."""
        best, p, n = math.inf, 0.0, 0.0
        for m in sorted({r[0] for r in rows}, reverse=True):
            p += sum(r[1] for r in rows if r[0] == m)
            n += sum(r[2] for r in rows if r[0] == m)
            if p and p / (p + n) >= precision:
                best = m
        return best

    def margin(self, x: Column) -> Column:
        def expr(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(x[self.names[tree[0]]] <= tree[1], expr(tree[2])).otherwise(expr(tree[3]))

        out = F.lit(float(self.bias))
        for tree in self.trees:
            out = out + expr(tree)
        return out

    def chosen(self, x: Column) -> Column:
        least = F.lit(math.inf)
        for gen, t in self.thresholds.items():
            if t < math.inf:
                least = F.when(x["gen"] == gen, F.lit(t - 1e-9)).otherwise(least)
        return self.margin(x) >= least


def rewritten(text: Column) -> Column:
    """The text with base addresses obfuscated and telephone numbers without + and country code, each behind a mark."""
    plain = F.replace(text, F.lit(_MARK), F.lit(""))
    mail = F.regexp_replace(plain, r"(?:\G|(?<![A-Za-z0-9._%+-]))([A-Za-z0-9._%+-]++)@([A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)", f"{_MARK}$1 (at) $2")
    return F.regexp_replace(mail, r"\+[0-9]{1,3}[\x20-]?(?=[(0-9][\x20().0-9-]{8,16}(?![0-9]))", _MARK)


def fit(docs: DataFrame) -> Trees:
    """Trees from the candidates of two thirds of the documents, thresholds from those of the rest."""
    held = F.pmod(F.xxhash64(F.lit("held"), F.col("text")), F.lit(3)) == 0
    some = docs.where(F.col("text").isNotNull()).select(held.alias("held"), rewritten(F.col("text")).alias("text"))
    rows = some.select("held", F.explode(candidates(F.col("text"))).alias("c")).groupBy("held", *[F.col(f"c.{k}").alias(k) for k in FEATURES])
    counts = rows.agg(F.sum(F.col("c.label")).alias("pos"), F.sum(1 - F.col("c.label")).alias("neg")).collect()
    return Trees(*[sorted(tuple(r)[1:] for r in counts if r.held == side) for side in (False, True)])


def _apart(base: Column, more: Column) -> Column:
    """The spans of more that overlap none of base: sorted once, and walked along once."""
    # a base span at its start, another one at its end: what ends where a base span starts comes first
    none = F.lit(None).cast("struct<start:int,kind:int,end:int>")
    marks = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("is_base"), b["end"].alias("upto"), none.alias("span")))
    asked = F.transform(more, lambda c: F.struct(c["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(0).alias("upto"), c.alias("span")))

    def walked(events: Column) -> Column:
        ends = running_greatest(F.transform(events, lambda e: e["upto"]))
        free = F.zip_with(events, ends, lambda e, z: F.when((e["is_base"] == 0) & (z <= e["span"]["start"]), e["span"]))
        return F.filter(free, lambda x: x.isNotNull())

    return bound(F.array_sort(F.concat(marks, asked)), walked)


def find(docs: DataFrame, trees: Trees, key: str = "doc_id") -> DataFrame:
    """key, n_<base kind>, base (spans) and spans (base and added), in order of start and kind."""
    kind = "array<struct<start:int,kind:int,end:int>>"
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col(key).alias("k"), text)
    rows = rows.select("k", *[c.alias(k) for k, c in base_spans(F.col("text")).items()], candidates(F.col("text")).alias("more"))
    plain = lambda k: F.transform(F.col(k), lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(k)).alias("kind"), m["end"].alias("end")))
    rows = rows.withColumn("base", F.array_sort(F.concat(*[plain(k) for k in BASE_KINDS]).cast(kind)))
    likely = F.transform(F.filter("more", trees.chosen), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))).cast(kind)
    rows = rows.withColumn("spans", F.array_sort(F.concat(F.col("base"), _apart(F.col("base"), likely))))
    return rows.select(F.col("k").alias(key), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS], "base", "spans")


def written(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, *[f"n_{k}" for k in BASE_KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the first one's kind in brackets."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        cut = F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], cut, F.lit("["), F.get(names, s["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
