"""Personal data: high-recall candidates, boosted trees over format and context, calibrated thresholds; built-in functions only.

Fixed base patterns find e-mail addresses, IP addresses, card and phone numbers that are certain. Beside them, loose generators
propose spans that may overlap: addresses written out ("ann at mail dot com"), phone numbers without a plus sign, numbers in
groups, account numbers, secrets. Each candidate is described by its format and the text around it, and gradient-boosted trees
(Spark ML, fitted once for an application on rows made by a seeded generator) give it a probability. The trees are turned
into SQL, so that a text is judged in place. A threshold for each kind is the lowest that keeps the wanted precision on rows
not fitted on. Of overlapping candidates the most probable stays; base spans always stay.

All patterns are written so that matching is linear: runs are possessive, and a run is entered at its start only.
"""

from __future__ import annotations

import json
import random
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankops.llm.spans import match_spans, no_spans
from bankops.session import stored

# fixed: the base patterns, kind by kind in the order of results; these match what their plain forms match
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "iban", "secret", "ssn"]
# the generators: kind, a cheap test, pattern
GENERATORS = [
    ("email", r"(?i)[A-Za-z0-9._%+-] ?[(\[]? ?\bat\b ?[)\]]? ?[A-Za-z0-9-]", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]? ?\bat\b ?[)\]]? ?[A-Za-z0-9-]{1,63}+ ?[(\[]? ?(?:\bdot\b|\.) ?[)\]]? ?[A-Za-z]{2,12}+"),
    ("phone", "[0-9]-[0-9]", r"(?<![0-9+.-])[0-9]{2,4}+-[0-9]{3,4}+-[0-9]{3,4}+(?![0-9.-])"),
    ("phone", r"\([0-9]", r"\([0-9]{2,4}\) ?[0-9]{3,4}+[ .-][0-9]{3,4}+(?![0-9])"),
    ("phone", "[0-9][. ][0-9]", r"(?<![0-9+.-])[0-9]{3}+[. ][0-9]{3}+[. ][0-9]{4}+(?![0-9.-])"),
    ("ip", ":[0-9A-Fa-f]{1,4}:", r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}+:){7}[0-9a-f]{1,4}+(?![0-9a-f:])"),
    ("card", "[0-9]{4}[._/][0-9]", r"(?<![0-9.])[0-9]{4}+[._/][0-9]{4}+[._/][0-9]{4}+[._/][0-9]{4}+(?![0-9.])"),
    ("iban", "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])"),
    ("ssn", "[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("secret", "[:=]", r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[ _-]?key)[\"']? {0,3}[:=] {0,3}[\"']?[^\s\"']{8,}+"),
    ("secret", "[0-9A-Fa-f]{32}", r"(?i)(?<![0-9a-z])[0-9a-f]{32,}+(?![0-9a-z])"),
]
AROUND = 24  # characters of context on each side
FIT_ROWS, CHECK_ROWS, TREES, DEPTH, SEED = 3000, 1500, 8, 3, 11
WANTED_PRECISION = 0.98
SPAN = "struct<kind:string,s:int,e:int,p:double>"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does the check sum of a string of digits hold?"""
    places = F.sequence(F.lit(1), F.length(number))

    def weighed(i: Column) -> Column:
        d = F.substr(number, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(number) > 0, total % 10 == 0).otherwise(F.lit(False))


def base_spans(text: Column) -> dict[str, Column]:
    """The certain spans of each kind, from left to right."""
    part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    holds = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.forall(F.split(x["m"], r"\."), lambda y: (F.length(part(y)) <= 3) & (F.substr(part(y), F.lit(1), F.lit(3)).cast("int") <= 255)),
        "card": lambda x: F.length(digits(x["m"])).between(16, 19) & F.when(F.length(digits(x["m"])).between(16, 19), luhn(digits(x["m"]))).otherwise(F.lit(False)),
        "phone": lambda x: F.length(digits(x["m"])).between(8, 15),
    }
    tests = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    return {
        kind: F.when(tests.get(kind, text.rlike("[0-9]")), F.filter(match_spans(text, pattern), holds[kind])).otherwise(no_spans())
        for kind, pattern in BASE.items()
    }


def candidates(text: Column) -> Column:
    """array<struct<kind, s, e, m, left, right, rule>> of all proposals."""

    def proposed(rule: int, kind: str, test: str, pattern: str) -> Column:
        named = F.transform(
            match_spans(text, pattern),
            lambda x: F.struct(
                F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
                F.lower(F.substr(text, F.greatest(x["s"] - AROUND + 1, F.lit(1)), F.least(x["s"], F.lit(AROUND)))).alias("left"),
                F.lower(F.substr(text, x["e"] + 1, F.lit(AROUND))).alias("right"),
                F.lit(rule).alias("rule"),
            ),
        )
        empty = F.array().cast("array<struct<kind:string,s:int,e:int,m:string,left:string,right:string,rule:int>>")
        return F.when(text.rlike(test), named).otherwise(empty)

    return F.concat(*(proposed(i, *g) for i, g in enumerate(GENERATORS)))


_CONTEXT = {
    "phone": r"tel|phone|call|mobile|fax|ruf|móvil|llam|appel",
    "contact": r"mail|contact|write|reach|kontakt|contacto|écri",
    "secret": r"token|secret|password|passwd|key|credential",
    "account": r"iban|account|bank|konto|cuenta|compte|transfer",
    "person": r"ssn|social|security|insurance|tax",
    "number": r"order|invoice|version|page|isbn|issue|ref|part|serial|build|chapter|figure|commit|hash|sha",
}


def features(c: Column) -> Column:
    """Format and context of a candidate as numbers."""
    m, both = c["m"], F.concat(c["left"], F.lit(" "), c["right"])
    one = lambda x: F.when(x, 1.0).otherwise(0.0)
    count = lambda pattern: (F.length(m) - F.length(F.regexp_replace(m, pattern, ""))).cast("double")
    return F.array(
        c["rule"].cast("double"),
        F.length(m).cast("double"),
        count("[0-9]"),
        count("[A-Za-z]"),
        count("[^0-9A-Za-z]"),
        count("[A-Z]"),
        one(m.rlike("[a-z]") & m.rlike("[0-9]")),
        one(m.rlike(r"[(\[]")),
        one(m.rlike("^(19|20)[0-9]{2}[^0-9]|[^0-9](19|20)[0-9]{2}$")),
        one(m.rlike("^[0-9]{3}-0[0-9]-|^000|^666|^9")),
        one(m.rlike("(.)\\1\\1\\1")),
        one(c["right"].rlike("^[A-Za-z0-9]") | c["left"].rlike("[A-Za-z0-9]$")),
        *(one(both.rlike(x)) for x in _CONTEXT.values()),
    )


def made_rows(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """Labelled texts from a seeded generator: formats of personal data, and numbers and words that look alike."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    word = lambda: rng.choice("an ber col da el fro gi ho".split()) + rng.choice("ria nt mo son ley tta vik ra".split())
    good = [
        (lambda: f"{word()} at {word()} dot {rng.choice(['com', 'org', 'net', 'de'])}", "contact me by mail|write to|reach me|kontakt"),
        (lambda: f"{word()} at {word()} dot {rng.choice(['com', 'org', 'net', 'de'])}".upper(), "contact me by mail|WRITE TO|reach me|NOW"),
        (lambda: f"{word()} [at] {word()}.{rng.choice(['com', 'org', 'fr'])}", "mail|contact|address"),
        (lambda: f"{num(3)}-{num(3)}-{num(4)}", "call me|tel|phone|mobile|fax|and"),
        (lambda: f"({num(3)}) {num(3)}-{num(4)}", "call|tel|phone|in|at"),
        (lambda: f"{num(3)}.{num(3)}.{num(4)}", "call|tel|phone|mobile"),
        (lambda: ":".join(hexes(4) for _ in range(8)), "host|address|from|server"),
        (lambda: ".".join(num(4) for _ in range(4)), "card|pay with|visa|number"),
        (lambda: f"DE{num(2)}" + "".join(num(4) for _ in range(4)) + num(2), "iban|bank account|konto|transfer to"),
        (lambda: f"{num(3)}-1{num(1)}-{num(4)}", "ssn|social security|tax id|number"),
        (lambda: f'{rng.choice(["token", "secret", "api_key", "password"])} = "{hexes(40)}', "with|set|the|config"),
        (lambda: hexes(32), "token|secret key|credential|password"),
        (lambda: hexes(rng.choice([64, 128])).upper(), "token|SECRET KEY|credential|Password"),
        (lambda: f'{rng.choice(["token", "secret", "api_key", "password"])}: {hexes(rng.choice([20, 200, 400]))}', "with|set|the|config"),
    ]
    bad = [
        (lambda: f"{word()} at {word()}. {word().title()}", "we met|they looked|arrived with|the"),
        (lambda: f"{word()} at {word()}. {word()}".upper(), "WE MET|they looked|ARRIVED WITH|the"),
        (lambda: f"{num(3)}-{num(3)}-{num(4)}", "order|invoice|part|serial no|isbn"),
        (lambda: f"20{num(2)}-{num(3)}-{num(3)}", "issue|page|version|on"),
        (lambda: f"{num(3)}.{num(3)}.{num(4)}", "version|build|total of|chapter"),
        (lambda: f"({num(4)}) {num(3)}-{num(3)}", "page|issue|chapter|ref"),
        (lambda: ".".join(num(4) for _ in range(4)), "version|build|page|serial"),
        (lambda: f"AB{num(2)}{word().upper()}1{num(4)}", "part|serial|order|ref"),
        (lambda: f"000-0{num(1)}-{num(4)}", "part|order|page|ref"),
        (lambda: "password: (required)", "field|form|enter|the"),
        (lambda: hexes(40), "commit|hash|build|sha"),
        (lambda: hexes(64).upper(), "COMMIT|hash|build|sha"),
    ]
    rows = []
    for _ in range(n):
        k = rng.randrange(len(good) + len(bad))
        form, context = (good + bad)[k]
        text = f"{word()} {word()} {rng.choice(context.split('|'))} {form()} {word()} {word()}"
        rows.append({"text": text, "label": float(k < len(good))})
    named = F.from_json(F.lit(json.dumps(rows)), "array<struct<text:string,label:double>>")
    return spark.range(1).select(F.inline(named))


def _tree_sql(lines: list[str], at: int = 0) -> tuple[str, int]:
    """One tree of Spark's debug text as a CASE expression over the array ``f``; the line after it."""
    line = lines[at].strip()
    if line.startswith("Predict:"):
        return f"{float(line.split(':')[1])}D", at + 1
    feature, value = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    yes, at = _tree_sql(lines, at + 1)
    no, at = _tree_sql(lines, at + 1)  # the line at ``at`` says Else
    return f"(CASE WHEN f[{feature}] <= {float(value)}D THEN {yes} ELSE {no} END)", at


class Detector:
    """The boosted trees as SQL, and a threshold for each kind."""

    def __init__(self, spark: SparkSession):
        named = candidates(F.col("text"))

        def rows(n: int, seed: int) -> DataFrame:
            x = stored(made_rows(spark, n, seed)).select("label", F.explode(named).alias("c"))
            return x.select("label", F.col("c.kind").alias("kind"), features(F.col("c")).alias("f"))

        fit = rows(FIT_ROWS, SEED).select("label", array_to_vector("f").alias("features"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.5).fit(fit)
        trees, weights = model.trees, model.treeWeights
        parts = []
        for tree, w in zip(trees, weights):
            lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
            parts.append(f"{w}D * {_tree_sql(lines)[0]}")
        self.margin = " + ".join(parts)
        checked = rows(CHECK_ROWS, SEED + 1).select("label", "kind", F.expr(self.probability("f")).alias("p")).collect()
        self.thresholds = {}
        for kind in KINDS:
            right, best = 0, 1.01
            found = sorted(((r["p"], r["label"]) for r in checked if r["kind"] == kind), reverse=True)
            for i, (p, y) in enumerate(found):
                right += y
                last = i + 1 == len(found) or found[i + 1][0] < p
                if last and p >= 0.5 and right >= WANTED_PRECISION * (i + 1):
                    best = p
            self.thresholds[kind] = best

    def probability(self, features_sql: str) -> str:
        """SQL for the probability of one candidate."""
        margin = self.margin if features_sql == "f" else self.margin.replace("f[", f"{features_sql}[")
        return f"1 / (1 + exp(-2 * ({margin})))"


_detectors: dict[str, Detector] = {}


def detector(spark: SparkSession) -> Detector:
    """Fitted once for an application; the fit is seeded."""
    key = spark.sparkContext.applicationId
    if key not in _detectors:
        _detectors[key] = Detector(spark)
    return _detectors[key]


def overlaps(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def find_pii(docs: DataFrame, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (new name: column), base (map of kind to spans), spans (array of kind, s, e, p) of every row.

    ``spans`` is by kind as in KINDS, then start; p is 1 for base spans. Of candidates that overlap the more probable one stays, of
    equally probable ones the first. A null text is an empty one with no spans; texts are read whole, repeated rows each. Names of other
    columns cannot clash: only ``keep`` and the text are read. An empty table gives no rows.
    """
    model = detector(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*(F.col(old).alias(new) for new, old in keep.items()), text.alias("_text"))
    base = base_spans(F.col("_text"))
    rows = rows.select("*", *(x.alias(f"_{kind}") for kind, x in base.items()), candidates(F.col("_text")).alias("_found"))
    certain = F.concat(*(_certain(kind) for kind in BASE))
    described = F.transform("_found", lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), features(c).alias("f")))
    rows = rows.withColumn("_base", certain).withColumn("_found", described)
    limit = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {v}D" for k, v in model.thresholds.items()) + " END"
    judged = F.expr(f"transform(_found, x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e, 'p', {model.probability('x.f')}, 'limit', {limit}))")
    rows = rows.withColumn("_found", judged)
    good = F.filter("_found", lambda x: (x["p"] >= x["limit"]) & ~F.exists("_base", lambda b: overlaps(x, b)))
    good = F.array_sort(F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["p"].alias("p"), x["kind"].alias("kind"))))

    def step(acc: Column, x: Column) -> Column:
        one = F.array(F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["p"].alias("p")))
        last = F.try_element_at(acc, F.lit(-1))
        clash = last.isNotNull() & (x["s"] < last["e"])
        but_last = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(~F.coalesce(clash, F.lit(False)), F.concat(acc, one)).when(x["p"] > last["p"], F.concat(but_last, one)).otherwise(acc)

    extra = F.aggregate(good, F.array().cast(f"array<{SPAN}>"), step)
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    keyed = F.transform(F.concat(F.col("_base"), extra), lambda x: F.struct(rank[x["kind"]].alias("r"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["p"].alias("p")))
    spans = F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["p"].alias("p")))
    return rows.select(*keep, F.col("_base").alias("base"), spans.alias("spans"), "_text")


def _certain(kind: str) -> Column:
    return F.transform(
        f"_{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lit(1.0).alias("p"))
    )


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row; code points, end exclusive.

    A null id is kept; repeated rows are scanned each; a text without personal data has empty spans. See ``find_pii``.
    """
    rows = find_pii(docs, {"doc_id": id_col}, text_col)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    sha = F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *(count(k) for k in BASE), sha, written(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in brackets."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = F.concat(acc["out"], F.substr(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
