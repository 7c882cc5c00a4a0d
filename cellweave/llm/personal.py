"""Personal data by weak supervision, with DataFrame functions and Spark ML only.

Base spans are exact: email, ip, card and phone as BASE states them, leftmost and not overlapping within a kind, those that fail their check dropped. All other candidates are base matches
that failed, and looser forms (LOOSE): masked addresses, national and 00 phone numbers, long addresses of hosts, account and security numbers, names. Labelers vote
on each candidate: two by regular expression (format, check digits), two by gazetteer (known endings and prefixes, known examples), and two by context (words before it that ask for such data, words that
speak of something else); each may abstain. Expectation-maximisation over the counts of vote patterns (kinds times three to the number of labelers, so at most a few
thousand rows on the driver) estimates each labeler's reliability for either class and each kind's share of personal data, and so a probability for each pattern. A logistic regression
over the candidate's shape and the words about it learns these probabilities from about SAMPLE candidates at most, by a hash, as many of each pattern as there are or SAMPLE allows, and decides
which candidates in looser forms become spans beside the base ones; failed base matches only teach it what is none.

Patterns never go back over what they have read, so the time for a text is in proportion to its length, however long. Matches are found in one pass for each pattern; only they, with
CONTEXT characters on either side, are shuffled, and places come from running sums over a text's matches. Null and empty texts have no spans. Rows
are told apart by doc_id and a hash of the text: equal rows, and rows that share a doc_id or have none, each get the result of their own text. Without looser
forms nothing is trained and nothing added. An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import written

#: Base patterns (fixed values), in a form that never backtracks; email may only begin where a run of its characters begins or an email has ended.
RUN_BEGINS, ADDRESS = r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
BASE = {
    "email": rf"(?:\G|{RUN_BEGINS}){ADDRESS}",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to be searched.
HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Gazetteers.
GIVEN_NAMES = ("James", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Anthony", "Andrew", "Joshua", "Patricia", "Jennifer", "Elizabeth", "Barbara", "Susan", "Jessica", "Margaret", "Michelle", "Amanda", "Stefan", "Wolfgang", "Andreas", "Matthias", "Katharina", "Sabine", "Claudia", "Pierre", "Philippe", "François", "Nicolas", "Isabelle", "Nathalie", "Alejandro", "Fernando", "Francisco", "Carmen", "Lucía", "Dolores")
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "eu", "uk", "us", "ca", "au", "de", "at", "ch", "fr", "be", "es", "mx", "ar", "it", "nl", "pl", "jp", "cn", "in", "br")
CALLING = ("1", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "86", "91")
#: Other numbers, and addresses that stand for nobody.
NOBODY = r"^(?:0+|1+|9+|1?2345678901?2?3?4?5?6?|1\.2\.3\.4|0\.0\.0\.0|127\..*|255\..*|000-.*|666-.*)$"
ASKING = ("mail", "email", "courriel", "correo", "contact", "kontakt", "contacto", "write", "schreiben", "reach", "call", "phone", "tel", "telephone", "telefon", "teléfono", "téléphone", "mobile", "handy", "fax", "card", "visa", "mastercard", "karte", "carte", "tarjeta", "pay", "payment", "ip", "host", "address", "adresse", "dirección", "login", "account", "konto", "compte", "cuenta", "iban", "ssn", "security", "name", "named", "dear", "mr", "mrs", "ms", "dr", "sincerely", "regards")
OTHERWISE = ("version", "v", "release", "build", "rev", "revision", "commit", "hash", "sha", "token", "id", "isbn", "issn", "doi", "order", "invoice", "part", "page", "pages", "figure", "table", "section", "chapter", "years", "pixels", "rows", "lines", "port", "size")
#: Looser forms. One pattern finds them, base forms first, so that none begins within a base match.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z]{2,24}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])|(?<![0-9])00[1-9][0-9\x20().-]{8,16}+(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(GIVEN_NAMES)})(?:\x20\p{{Lu}}\.)?\x20\p{{Lu}}\p{{Ll}}{{1,24}}+(?!\p{{L}})",
}
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "name")
#: How often each labeler is expected to be right, before anything is seen.
LABELERS = {"format": 0.6, "check": 0.95, "known": 0.7, "example": 0.95, "asking": 0.85, "otherwise": 0.85}
CONTEXT, SAMPLE, FEATURES, LEAST_PROBABILITY = 40, 20_000, 1 << 12, 0.5
#: A failed card match is a candidate from so many digits on; less is any number.
LEAST_DIGITS = 12
#: Votes that this expectation counts for, of either class; rounds at most, and when they stop.
PRIOR, ROUNDS, ENOUGH = 50.0, 200, 1e-9


def digits_of(match: Column) -> Column:
    return F.translate(match, " -().+", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others; for few digits only."""
    n = F.length(digits)

    def digit(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + digit(i)) % 10 == 0


def account_checks(match: Column) -> Column:
    """The remainder by 97 that account numbers must have."""
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise((a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97))
    return rest == 1


def valid(kind: Column, match: Column) -> Column:
    """Whether a base match passes its check."""
    n = F.length(digits_of(match))
    parts = F.forall(F.split(match, r"\."), lambda p: F.coalesce(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int") <= 255, F.lit(False)))
    card = F.when(n.between(14, 19), luhn(digits_of(match))).otherwise(False)
    return F.when(kind == "email", True).when(kind == "ip", parts).when(kind == "card", card).otherwise(n.between(10, 15))


def matches(docs: DataFrame, pattern: str, kind: Column, hint: str = "") -> DataFrame:
    """doc_id, t, kind, nth, gap (from the match before), match, before and after (CONTEXT characters)."""
    some = docs.where(F.contains("text", F.lit(hint))) if hint else docs
    some = some.withColumn("found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).where(F.size("found") > 0)
    some = some.select("doc_id", "t", "found", F.split("text", pattern, -1).alias("rest"))
    near = lambda x, i: F.struct(i.alias("nth"), F.length(F.get("rest", i)).alias("gap"), x.alias("match"), F.right(F.get("rest", i), F.lit(CONTEXT)).alias("before"), F.left(F.get("rest", i + 1), F.lit(CONTEXT)).alias("after"))
    each = some.select("doc_id", "t", F.inline(F.transform("found", near)))
    return each.select("doc_id", "t", kind.alias("kind"), *each.columns[2:])


def placed(each: DataFrame, by: str) -> DataFrame:
    """The matches with start and end; equal rows of documents are one. Running sums over the matches of one text."""
    one = each.dropDuplicates(["doc_id", "t", by, "nth"])
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(Window.partitionBy("doc_id", "t", by).orderBy("nth"))
    return one.withColumn("end", end).withColumn("start", F.col("end") - size).drop("nth", "gap")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, t, kind, start, end, match, before, after, base (a base span) and strict (in a base form): base spans, failed base matches, and looser forms."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    found = None
    for kind, pattern in BASE.items():
        part = matches(texts, pattern, F.lit(kind), HINT[kind])
        found = part if found is None else found.unionAll(part)
    base = placed(found, "kind").withColumn("base", valid(F.col("kind"), F.col("match"))).withColumn("strict", F.lit(True))
    base = base.where(F.col("base") | (F.col("kind") != "card") | (F.length(digits_of(F.col("match"))) >= LEAST_DIGITS))
    of_form = F.coalesce(*[F.when(F.col("match").rlike(f"^(?:{p})$"), F.lit(k)) for k, p in LOOSE.items()])
    either = "|".join([RUN_BEGINS + ADDRESS, BASE["phone"], *LOOSE.values(), BASE["ip"], r"[0-9]{4}(?:[\x20-]?[0-9])++"])
    loose = placed(matches(texts, either, F.lit("")), "kind").withColumn("kind", of_form)
    loose = loose.where(F.col("kind").isNotNull()).withColumn("base", F.lit(False)).withColumn("strict", F.lit(False))
    return base.unionByName(loose)


def votes(found: DataFrame) -> DataFrame:
    """The candidates with a vote of each labeler: 1 personal, 0 not, -1 abstains."""
    kind, match, n = F.col("kind"), F.col("match"), F.length(digits_of(F.col("match")))
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")
    last = F.slice(F.reverse(words(F.col("before"))), 1, 4)
    near = F.concat(last, F.slice(words(F.col("after")), 1, 2))
    listed = lambda some: F.array(*map(F.lit, some))
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    digits = digits_of(match)
    checked = F.when(kind.isin("ip", "card", "phone") & F.col("strict"), valid(kind, match)).when(kind == "iban", account_checks(match)).when(kind == "phone", n.between(10, 15))
    ending = F.lower(F.regexp_extract("match", r"([A-Za-z0-9-]+)$", 1)).isin(*ENDINGS)
    calling = F.exists(listed(CALLING), lambda c: F.startswith(F.regexp_replace(digits, "^00", ""), c))
    known = F.when(kind == "email", ending).when(kind == "phone", calling & F.col("match").rlike(r"^(?:\+|00)")).when(kind == "card", F.left(digits, F.lit(1)).isin("3", "4", "5", "6")).when(kind == "name", True)
    nobody = digits.rlike(NOBODY) | match.rlike(NOBODY)
    asks, other = F.arrays_overlap(last, listed(ASKING)), F.arrays_overlap(near, listed(OTHERWISE))
    chosen = {
        "format": vote(F.col("strict") | kind.isin("ssn", "iban"), F.lit(False)),
        "check": vote(checked, ~checked),
        "known": vote(known, ~known & (kind != "phone")),
        "example": vote(F.lit(False), nobody),
        "asking": vote(asks, F.lit(False)),
        "otherwise": vote(F.lit(False), other),
    }
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.left("match", F.lit(48)), r"[0-9]", "9"), r"\p{Lu}", "A"), r"\p{Ll}+", "a")
    tag = lambda name, x: F.concat(F.lit(f"{name}:"), x)
    features = F.concat(F.array(tag("kind", kind), tag("shape", F.concat(kind, F.lit(" "), shape)), tag("digits", F.concat(kind, n.cast("string"))), tag("checked", F.concat(kind, F.coalesce(checked.cast("string"), F.lit("")))), tag("known", F.concat(kind, F.coalesce(known.cast("string"), F.lit("")))), tag("nobody", nobody.cast("string"))), F.transform(last, lambda w: tag("before", w)), F.transform(F.slice(words(F.col("after")), 1, 2), lambda w: tag("after", w)))
    return found.withColumn("votes", F.array(*[chosen[k].cast("int") for k in LABELERS])).withColumn("features", features)


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> tuple[dict, list[list[dict]], dict]:
    """Expectation-maximisation over vote patterns (kind, votes, count): each kind's share of personal data, each labeler's chances of its votes for either class (0, 1), and a probability for each pattern.

    To abstain is a vote like others: a labeler that only ever says yes tells something by its silence.
    """
    share = dict.fromkeys({k for k, _, _ in patterns}, 0.5)
    prior = [[{y: PRIOR * c / 2, 1 - y: PRIOR * (1 - c) / 2, -1: PRIOR / 2} for y in (0, 1)] for c in LABELERS.values()]
    chances = [[{v: n / PRIOR for v, n in of.items()} for of in both] for both in prior]
    posterior: dict = {}
    for _ in range(ROUNDS):
        before, posterior = posterior, {}
        for kind, vote, _ in patterns:
            log = [math.log(1 - share[kind]), math.log(share[kind])]
            for both, v in zip(chances, vote, strict=True):
                log = [x + math.log(of[v]) for x, of in zip(log, both, strict=True)]
            posterior[kind, vote] = 1 / (1 + math.exp(max(-700.0, min(700.0, log[0] - log[1]))))
        for kind in share:
            own = [(posterior[k, v], n) for k, v, n in patterns if k == kind]
            share[kind] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        for j, both in enumerate(prior):
            for y, of in enumerate(both):
                seen = dict(of)
                for k, v, n in patterns:
                    seen[v[j]] += n * (posterior[k, v] if y else 1 - posterior[k, v])
                chances[j][y] = {v: n / sum(seen.values()) for v, n in seen.items()}
        if before and max(abs(posterior[x] - before[x]) for x in posterior) < ENOUGH:
            break
    return share, chances, posterior


def added(found: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The candidates in looser forms that the trained classifier takes for personal data; those in base forms only teach it."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    looser = found.where("not strict")
    if looser.isEmpty():
        return looser
    patterns = [(r.kind, tuple(r.votes), r["count"]) for r in found.groupBy("kind", "votes").count().collect()]  # at most kinds times 3 to the number of labelers
    spark = found.sparkSession
    posterior = reliabilities(patterns)[2]
    told = sorted((k, list(v), posterior[k, v], sample / len(patterns) / n) for k, v, n in patterns)
    soft = found.join(F.broadcast(spark.createDataFrame(told, "kind string, votes array<int>, p double, part double")), ["kind", "votes"])
    hashed = HashingTF(inputCol="features", outputCol="vector", numFeatures=FEATURES, binary=True)
    taken = soft.where(F.pmod(F.xxhash64("doc_id", "t", "start", "kind"), F.lit(1 << 20)) < F.col("part") * (1 << 20))
    p = F.greatest(F.least("p", F.lit(0.999)), F.lit(0.001))
    rows = hashed.transform(taken.withColumn("side", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), p.alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - p).alias("weight"))))).select("features", "side.*"))
    model = LogisticRegression(featuresCol="vector", weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(written(rows.select("vector", "label", "weight"), "pii-examples"))
    scored = model.transform(hashed.transform(looser))
    return scored.where(vector_to_array("probability")[1] >= LEAST_PROBABILITY).select(*found.columns)


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row."""
    found = written(votes(candidates(docs)), "pii-candidates")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    each = found.where("base").select("doc_id", "t", "kind", "start", "end", "base").unionAll(added(found, sample).select("doc_id", "t", "kind", "start", "end", "base")).dropDuplicates(["doc_id", "t", "kind", "start", "end"])
    span = F.struct("start", rank.alias("rank"), "end", "kind", "base")
    lists = each.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(span)).alias("all"), *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE])  # as many as a text's matches
    text = lambda some: F.array_join(F.transform(some, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    lists = lists.select(F.col("doc_id").alias("found_id"), F.col("t").alias("found_t"), *[f"n_{k}" for k in BASE], text(F.filter("all", lambda x: x.base)).alias("base_spans"), text(F.col("all")).alias("spans"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    both = ids.join(lists, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("t") == F.col("found_t")), "left")
    return both.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
