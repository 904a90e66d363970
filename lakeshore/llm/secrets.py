"""Secret scans (operator 2): candidates by pattern, false positives removed by
a random forest over their length, character transitions, dictionary coverage,
path and neighbouring words, trained from labelled findings.

Everything is DataFrame functions and Spark ML on the JVM.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import drawn, matched, saved, with_text
from lakeshore.plans.joins import sized_broadcast

# A candidate: 16 or more characters of keys, hashes and encoded bytes, with a
# digit or a change from lower to upper case; and whatever is assigned to a key
# word or is the password of a URL, from six characters on.
VALUE = r"[A-Za-z0-9][A-Za-z0-9_+/.\-]{14,}[A-Za-z0-9_+/\-]={0,2}"
MAYBE = r"[A-Za-z0-9_+/.\-]{16}"
VARIED = r"[0-9]|[a-z][A-Z]"
KEY_WORDS = r"token|secret|passw|pwd|api.?key|access.?key|auth|credential|private|bearer"
NEUTRAL_WORDS = r"commit|revision|checksum|digest|version|uuid|build|hash|sha\d*$"
# A key word's name, the sign behind it, and the value: in quotes, or up to
# white space without the punctuation that closes it; a scheme is no value.
NAME = rf"(?i)(?:{KEY_WORDS})[A-Za-z0-9_.\-]{{0,64}}[\"'`\]]{{0,2}}"
SIGN = r"(?:=>|:=|==?|:)"
RUN = r"(?:([\"'`])((?:(?!\1)\S){6,})\1|((?![\"'`]|(?i:bearer|basic)$)\S{5,}[^\s,;)\]}>.\"'`]))"
SCHEME = r"(?i)\b(?:bearer|basic)$"
URL_PASSWORD = r"[A-Za-z][A-Za-z0-9+.\-]{0,20}://[^\s/:@]{0,200}:([^\s/@]{6,})@"
# A quoted value of several words; possessive, so that no line is read twice.
PHRASE = (rf"{NAME}[\x20\t]{{0,8}}{SIGN}[\x20\t]{{0,8}}"
          r"(?:\"[^\"\s]*+[\x20\t][^\"\r\n]*+\"|'[^'\s]*+[\x20\t][^'\r\n]*+')")
PROVIDER = (r"^(?:A[KS]IA[0-9A-Z]{12}|gh[pousr]_|github_pat_|glpat-|xox[abeoprs]-|[srp]k[-_](?:live|test|ant|proj)|"
            r"AIza|ya29\.|npm_|pypi-|SG\.|hf_|dop_v1_|shpat_|eyJ[A-Za-z0-9_\-]{8,})")
PEM = r"PRIVATE KEY-----$|(?:^|\s)[A-Za-z0-9+/]{60,76}$"
PATH_SAMPLES = r"test|example|sample|mock|fixture|docs?/"
PATH_SETTINGS = r"\.(env|pem|key|cfg|conf|ini|ya?ml|json|properties|toml)$"

# A word of the dictionary occurs in this share of all documents, and in so
# many of them at least.
WORD_SHARE, WORD_DOCUMENTS = 1e-4, 3
TRAIN_DOCUMENTS = 4000
TREES, DEPTH, SEED = 20, 8, 7
THRESHOLD = 0.5
REDACTED = "[SECRET]"
# Up to this size the values to redact go to the texts; beyond, both are shuffled.
REDACT_BYTES = 16 << 20

KEY = ["doc_id", "text_hash", "at", "nth"]
FEATURES = ["length", "digits", "upper", "lower", "other", "distinct", "switches", "hexadecimal", "surprise",
            "coverage", "neighbours", "key_word", "neutral_word", "assigned", "quoted", "path_sample",
            "path_settings", "path_depth", "provider", "url_password", "scheme", "pem"]
FINDING = [*KEY, "value", "before", "prefix", "suffix", "after", "path"]


class Words(NamedTuple):
    """What the corpus says about words: ``terms`` (column term) is its
    dictionary, ``pairs`` (pair, log_p) the log probability of the second of
    two letters a to z after the first, over all words."""
    terms: DataFrame
    pairs: DataFrame


def dictionary(docs: DataFrame) -> Words:
    """Words of three or more letters over all texts; the dictionary's are
    those in WORD_SHARE of the documents, at least WORD_DOCUMENTS."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"\p{L}{3,}"), F.lit(0)))
    counts = saved(docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "words")
    least = max(WORD_DOCUMENTS, int(WORD_SHARE * docs.count()))
    return Words(saved(counts.where(F.col("n") >= least).select("term"), "dictionary"), transitions(counts))


def transitions(counts: DataFrame) -> DataFrame:
    """(pair, log_p) by words (term) and their numbers (n); add-one over the 26
    letters. At most 26 * 26 rows."""
    pairs = counts.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.substring(
        F.col("term"), i, F.lit(2)))).alias("pair")).where(F.col("pair").rlike("^[a-z]{2}$"))
    sums = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    of_first = sums.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    joined = sums.join(F.broadcast(of_first), F.substring("pair", 1, 1) == F.col("first"))
    return saved(joined.select("pair", F.log((F.col("n") + 1) / (F.col("total") + 26)).alias("log_p")), "letter-pairs")


def _assigned_values(before: Column, word: Column) -> Column:
    """Values in ``word`` that a key word names, in it or at the end of
    ``before``, and passwords of URLs in it."""
    def runs(text: Column, lead: str) -> list[Column]:
        return [F.regexp_extract_all(text, F.lit(lead + RUN), F.lit(i)) for i in (2, 3)]

    none = F.array().cast("array<string>")
    within = runs(word, NAME + SIGN)
    named = before.rlike(rf"{NAME} ?{SIGN}$") | before.rlike(SCHEME)
    behind = [F.when(named, c).otherwise(none) for c in runs(word, "^")]
    signed = [F.when(before.rlike(NAME + "$"), c).otherwise(none) for c in runs(word, "^" + SIGN)]
    url = F.regexp_extract_all(word, F.lit(URL_PASSWORD), F.lit(1))
    return F.filter(F.concat(*within, *behind, *signed, url), lambda v: v != "")


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: its key (doc_id, text_hash, number of the word,
    number within the word; negative for a quoted value of several words),
    value, the two words before, what stands before and behind it in its own
    word, the word after, and the document's path (column source; empty where
    the table has none)."""
    path = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), path.alias("path"))
    key_word = rf"(?i)(?:{KEY_WORDS}|basic)|://"
    texts = texts.where(F.col("text").rlike(MAYBE) | F.col("text").rlike(key_word)).withColumn(
        "text_hash", F.xxhash64("text"))
    split = texts.withColumn("words", F.split("text", r"[\x20\x09-\x0D]+"))

    def word(i: Column) -> Column:
        return F.coalesce(F.get("words", i), F.lit(""))

    def maybe(i: Column) -> Column:
        return word(i).rlike(MAYBE) | (F.length(word(i)) >= 6) & F.concat_ws(" ", word(i - 2), word(i - 1), word(i)).rlike(
            key_word)

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), maybe)
    found = F.transform(places, lambda i: F.struct(
        i.alias("at"), word(i).alias("word"), F.concat_ws(" ", word(i - 2), word(i - 1)).alias("before"),
        word(i + 1).alias("after")))
    rows = split.select("doc_id", "text_hash", "path", F.explode(found).alias("x")).select(
        "doc_id", "text_hash", "path", "x.*")
    varied = F.filter(F.regexp_extract_all("word", F.lit(VALUE), F.lit(0)), lambda v: v.rlike(VARIED))
    assigned = F.filter(F.array_distinct(_assigned_values(F.col("before"), F.col("word"))),
                        lambda v: ~F.array_contains(F.col("varied"), v))
    rows = rows.withColumn("varied", varied).select("*", F.posexplode(F.concat("varied", assigned)).alias("nth", "value"))
    rows = (rows.withColumn("prefix", F.expr("substring_index(word, value, 1)"))
            .withColumn("suffix", F.expr("substr(word, length(prefix) + length(value) + 1)")))

    phrases = texts.select("*", F.posexplode(F.regexp_extract_all("text", F.lit(PHRASE), F.lit(0))).alias("i", "phrase"))
    quote = F.expr("right(phrase, 1)")
    phrases = (phrases.withColumn("at", F.size(F.split(F.expr("substring_index(text, phrase, 1)"),
                                                       r"[\x20\x09-\x0D]+")) - 1)
               .withColumn("nth", -1 - F.col("i")).withColumn("suffix", quote)
               .withColumn("value", F.regexp_extract("phrase", rf"{SIGN}[\x20\t]*[\"'](.*)[\"']$", 1))
               .where(F.length("value") >= 6)
               .withColumn("prefix", F.expr("left(phrase, length(phrase) - length(value) - 1)"))
               .withColumns({"before": F.lit(""), "after": F.lit("")}))
    return rows.select(*FINDING).unionAll(phrases.select(*FINDING))


def features(findings: DataFrame, words: Words) -> DataFrame:
    """``findings`` (columns FINDING, others kept) with the columns FEATURES."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    context = F.lower(F.concat_ws(" ", "before", "prefix"))
    plain = findings.select(
        "*", F.col("value").alias("__value"),
        size.cast("double").alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"), share("[^A-Za-z0-9]").alias("other"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"),
        share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])").alias("switches"),
        F.lower(value).rlike("^[0-9a-f]+$").cast("double").alias("hexadecimal"),
        context.rlike(KEY_WORDS).cast("double").alias("key_word"),
        context.rlike(NEUTRAL_WORDS).cast("double").alias("neutral_word"),
        context.rlike(r"(=|:|=>)[ \"'`]*$").cast("double").alias("assigned"),
        F.col("prefix").rlike("[\"'`]$").cast("double").alias("quoted"),
        F.lower("path").rlike(PATH_SAMPLES).cast("double").alias("path_sample"),
        F.lower("path").rlike(PATH_SETTINGS).cast("double").alias("path_settings"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        value.rlike(PROVIDER).cast("double").alias("provider"),
        F.col("prefix").rlike(r"://[^\s/:@]*:$").cast("double").alias("url_password"),
        ((F.col("prefix") == "") & F.col("before").rlike(SCHEME)).cast("double").alias("scheme"),
        (value.rlike(r"^[A-Za-z0-9+/]{16,76}={0,2}$") & F.col("before").rlike(PEM)).cast("double").alias("pem"))
    # Facts of a value and of its neighbouring words, once for each distinct one.
    runs = F.regexp_extract_all(F.lower("value"), F.lit(r"\p{L}+"), F.lit(0))
    values = findings.select("value").distinct()
    terms = sized_broadcast(words.terms)
    covered = (values.select("value", F.explode(runs).alias("term")).join(terms, "term")
               .groupBy("value").agg(F.sum(F.length("term")).alias("covered")))
    pairs = values.select("value", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("value") - 1),
        lambda i: F.substring(F.lower(F.col("value")), i, F.lit(2)))).alias("pair"))
    surprise = (pairs.join(F.broadcast(words.pairs), "pair", "left").groupBy("value")
                .agg((-F.avg(F.coalesce("log_p", F.lit(-12.0)))).alias("surprise")))
    near = F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit(r"\p{L}+"), F.lit(0))
    sides = findings.select("before", "after").distinct()
    known = (sides.select("before", "after", F.explode(near).alias("term")).join(terms, "term")
             .groupBy("before", "after").agg(F.count(F.lit(1)).cast("double").alias("neighbours")))
    out = (plain.join(covered, "value", "left").join(surprise, "value", "left")
           .join(known, ["before", "after"], "left"))
    return out.select(*findings.columns, *(F.coalesce(c, F.lit(0.0)).alias(name) for name, c in (
        (f, F.col("covered") / F.col("length") if f == "coverage" else F.col(f)) for f in FEATURES)))


def train(labelled: DataFrame, terms: Words) -> RandomForestClassificationModel | None:
    """A forest from labelled findings: columns FINDING and label (1: secret, 0:
    false positive; null labels don't count). None unless both labels occur."""
    labelled = saved(labelled.where("label IS NOT NULL"), "labelled-findings")
    rows = saved(features(labelled, terms).select(
        *FEATURES, F.col("label").cast("double").alias("label")), "training-rows")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features",
                                    labelCol="label")
    return forest.fit(_assembled(rows))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)


def scan(docs: DataFrame, model: RandomForestClassificationModel | None, terms: Words) -> DataFrame:
    """One row per candidate of every whole text: FINDING, score (probability
    of a secret), is_secret (from THRESHOLD on). Without a model every
    candidate stays, with score 1.

    Null or empty text: no candidates. Null doc_id: kept. Repeated rows: one
    set of candidates each. An empty table gives no rows.
    """
    found = saved(candidates(docs), "candidates")
    if model is None:
        return found.withColumns({"score": F.lit(1.0), "is_secret": F.lit(True)})
    scored = model.transform(_assembled(features(found, terms)))
    return (scored.withColumn("score", vector_to_array("probability")[1])
            .select(*FINDING, "score", (F.col("score") >= THRESHOLD).alias("is_secret")))


def measure(labelled: DataFrame, terms: Words, folds: int = 4, fold: int = 2) -> dict[str, float]:
    """Precision and recall of a forest on the labelled findings of one fold of
    the documents (by a hash of doc_id), trained on those of the others."""
    inside = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold
    labelled = saved(labelled.where("label IS NOT NULL AND doc_id IS NOT NULL"), "measured-findings")
    model = train(labelled.where(~inside), terms)
    if model is None:
        return {"findings": 0, "precision": 0.0, "recall": 0.0}
    judged = model.transform(_assembled(features(labelled.where(inside), terms).withColumnRenamed("label", "truth")))
    said, true = vector_to_array("probability")[1] >= THRESHOLD, F.col("truth") == 1
    n, hits, said_n, true_n = judged.agg(F.count(F.lit(1)), F.count_if(said & true), F.count_if(said),
                                         F.count_if(true)).first()
    return {"findings": n, "precision": hits / max(1, said_n), "recall": hits / max(1, true_n)}


def derived_findings(docs: DataFrame, terms: Words, documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Labelled findings derived from the corpus, for when no reviewed ones are
    given: from about ``documents`` documents drawn by hash (a documented bound
    of the training sample; documents without id are not drawn). Real candidates are labelled by strict
    rules: secrets are varied values of high entropy assigned to a secret's
    name or marked by their own form (provider's prefix, JWT, password in a
    URL, bearer, PEM line); not secrets are plain numbers, addresses, named
    digests and values of dictionary words that nothing assigns or marks; the
    others stay unlabelled. Beside each chosen document stand values of known
    make in its path and words: secrets with and without an assigned name, and
    placeholders, named digests, numbers, addresses, paths and words joined
    with numbers (not secrets).
    """
    # Written once: everything below reads the sample several times.
    columns = [c for c in ("doc_id", "text", "source") if c in docs.columns]
    known = docs.select(*columns).where("doc_id IS NOT NULL")
    sample = saved(drawn(known, documents, "doc_id", "text").dropDuplicates(["doc_id", "text"]), "secret-sample")
    real = features(saved(candidates(sample), "sample-candidates"), terms)
    marked = F.greatest("provider", "url_password", "scheme", "pem") == 1
    varied = (F.col("distinct") * F.col("length") >= 8) & (F.col("coverage") < 0.5)
    named = (F.col("key_word") == 1) & (F.col("assigned") == 1)
    secret = (F.col("neutral_word") == 0) & varied & (
        marked | named & (F.col("length") >= 16) & F.col("value").rlike(VARIED))
    address = F.col("prefix").rlike("@$") | F.col("suffix").rlike(r"^@[A-Za-z0-9.\-]+\.[a-z]+")
    plain = (F.col("value").rlike(r"^[0-9.,:/+\-]+$") | address | (F.col("coverage") >= 0.5)
             | (F.col("neutral_word") == 1) & (F.col("hexadecimal") == 1))
    label = F.when(secret, 1).when(plain & ~marked & ~named, 0)
    real = real.select(*FINDING, label.cast("int").alias("label"))

    path = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in columns else F.lit("")
    words = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    seed = F.col("doc_id").cast("string")
    rows = sample.dropDuplicates(["doc_id"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), seed.alias("seed"),
        *(F.coalesce(F.get(words, F.lit(i)), F.lit("")).alias(f"w{i}") for i in range(4)))

    def letters(i: int) -> Column:
        return F.regexp_replace(F.lower(F.col(f"w{i}")), r"[^a-z]", "")

    digest, long_digest = F.sha1("seed"), F.sha2("seed", 256)
    key64 = F.regexp_replace(F.base64(F.unhex(long_digest)), r"^[+/]|=+$", "x")
    number = F.conv(F.substring(F.md5("seed"), 1, 13), 16, 10)
    name = F.element_at(F.array(*map(F.lit, ("token", "secret", "password", "api_key", "auth_token"))),
                        (F.pmod(F.xxhash64("seed"), F.lit(5)) + 1).cast("int"))
    neutral = F.element_at(F.array(*map(F.lit, ("commit", "checksum", "revision", "digest", "build"))),
                           (F.pmod(F.xxhash64("seed"), F.lit(5)) + 1).cast("int"))
    assigned, empty = F.concat(name, F.lit(" =")), F.lit("")
    quote = F.lit('"')
    def part(i: int, n: int) -> Column:
        """n characters of base64 of a hash of the document, other ones for each i."""
        return F.substring(F.translate(F.concat(*(F.base64(F.unhex(F.sha2(F.concat(seed, F.lit(f"/{i}/{j}")), 256)))
                                                  for j in range(n // 43 + 1))), "=", ""), 1, n)

    def word_like(i: int, n: int) -> Column:
        return F.translate(part(i, n), "+/", "-_")

    hard = F.concat(F.substring(F.translate(part(1, 12), "+/", "!&"), 1, 9), F.element_at(
        F.array(*map(F.lit, ("!7", "&3", "#9", "$1", "%k"))), (F.pmod(F.xxhash64("seed"), F.lit(5)) + 1).cast("int")))
    jwt = F.concat_ws(".", F.concat(F.lit("eyJ"), word_like(2, 30)), word_like(3, 40), word_like(4, 43))
    line, line2 = part(5, 64), part(6, 64)
    two = F.concat_ws(" ", "w0", "w1")
    bearer = F.lit("Authorization: Bearer")
    makes = [(digest, assigned, quote, 1), (F.upper(digest), F.concat(F.upper(name), F.lit(" =")), quote, 1),
             (key64, F.concat(F.col("w0"), F.lit(" "), name, F.lit(":")), empty, 1),
             (F.concat(F.lit("AKIA"), F.upper(F.substring(F.md5("seed"), 1, 16))), assigned, quote, 1),
             (F.concat(F.lit("AKIA"), F.upper(F.substring(F.md5("seed"), 1, 16))), two, empty, 1),
             (F.concat(F.lit("ghp_"), F.translate(part(7, 36), "+/", "xy")), two, empty, 1),
             (jwt, bearer, empty, 1), (jwt, two, empty, 1), (word_like(8, 40), bearer, empty, 1),
             (hard, F.col("w0"), F.concat(F.lit("postgres://"), letters(1), F.lit(":")), 1),
             (line, F.lit("PRIVATE KEY-----"), empty, 1), (line2, F.concat_ws(" ", part(9, 64), line), empty, 1),
             (F.substring(line, 1, 24), F.concat_ws(" ", line, line2), empty, 1),
             (hard, assigned, quote, 1), (hard, F.col("w0"), F.concat(name, F.lit("=")), 1),
             (F.translate(F.lower(part(10, 24)), "0123456789+/", "abcdefghijkl"), assigned, quote, 1),
             (long_digest, F.col("w0"), F.concat(name, F.lit("=")), 1),
             (F.concat_ws("_", letters(1), letters(2), F.lit("placeholder1")), assigned, quote, 0),
             (F.concat_ws(" ", letters(1), letters(2), letters(3)), assigned, quote, 0),
             (letters(1), F.concat(F.col("w0"), F.lit(" "), name, F.lit(":")), empty, 0),
             (F.concat(letters(1), letters(2)), F.concat(F.col("w0"), F.lit(" "), name, F.lit(":")), empty, 0),
             (digest, F.concat(neutral, F.lit(" =")), quote, 0), (long_digest, F.concat(F.col("w0"), F.lit(" "),
                                                                                       neutral), empty, 0),
             (F.concat(letters(1), letters(2), F.lit("/"), letters(3), F.lit("12")), F.col("w0"), empty, 0),
             (F.concat(letters(1), F.lit("."), letters(2), F.lit(".example.org")), F.col("w0"),
              F.concat(letters(3), F.lit("@")), 0),
             (F.concat(number, number), two, empty, 0),
             (F.concat_ws("-", letters(1), letters(2), letters(3), number), F.col("w0"), empty, 0)]
    made = F.explode(F.array(*(F.struct(v.alias("value"), b.alias("before"), p.alias("prefix"),
                                        F.lit(label).alias("label")) for v, b, p, label in makes)))
    derived = (rows.select("doc_id", "path", F.col("w3").alias("after"), made.alias("x"))
               .select("doc_id", "path", "after", "x.*")
               .where(F.length("value") >= 6)
               .select("doc_id", F.lit(0).cast("long").alias("text_hash"), F.lit(-1).alias("at"), F.lit(0).alias("nth"),
                       "value", "before", "prefix", F.lit('"').alias("suffix"), "after", "path", "label"))
    return real.unionByName(derived)


def redact(docs: DataFrame, secrets: DataFrame) -> DataFrame:
    """``docs``, all columns, each secret's value in its text replaced by
    REDACTED. ``secrets``: doc_id, text_hash and value. Other documents are
    returned unchanged."""
    values = saved(secrets.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False).alias("__secrets")),
        "redacted-values")
    text = F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(F.aggregate(
        "__secrets", F.col("text"), lambda t, x: F.replace(t, x["value"], F.lit(REDACTED))))
    values = sized_broadcast(values, max_bytes=REDACT_BYTES)
    return with_text(matched(docs, values, "left"), text).select(*docs.columns)
