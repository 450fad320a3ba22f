"""Secret scanning with a random forest, DataFrame functions and Spark ML only.

Candidates are long runs of key characters.  The forest sees a candidate's
length, its character transitions, how much of it common text covers
(dictionary coverage), the path it came from and its neighbouring words, and
is trained from labelled findings to tell secrets from false positives.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needbridge.llm.common import materialize

MIN_LENGTH = 16
#: Least length right after a word that names a secret.
CUED_LENGTH = 6
#: Labelled findings that train the forest, at most; seed of that sample and of the forest.
TRAIN_ROWS, SEED = 20_000, 5
#: The most common words, whose three-letter pieces are the dictionary.
DICTIONARY_WORDS = 2_000
THRESHOLD = 0.5
FEATURES = ("length", "upper", "lower", "digit", "mark", "shifts", "repeats", "variety", "hexadecimal", "coverage",
            "cue_before", "cue_word", "assigned", "quoted", "link", "prose_before", "prose_after", "path_kind", "path_code")
#: Words that name a secret, and places that hold samples.
_CUE = "(?i)(pass|pwd|secret|token|api|key|auth|cred|bearer|private)"
#: Such a word and what may stand between it and the secret.
_CUED = r"(?i)(pass|pwd|secret|token|api|key|auth|cred|bearer|private)[a-z0-9_-]*[\"']?\s*(:=|=>|[:=]|\bis\b)?\s*[\"']?$"
_SAMPLES = "(?i)(test|example|sample|doc|vendor)"


def scan(docs: DataFrame) -> DataFrame:
    """Candidates: doc_id, path, start, candidate, lead, before, after (start in code points).

    A candidate is a run of at least MIN_LENGTH letters, digits and ``+/_-``
    with a digit in it, or of capitals; right after a word that names a secret,
    of at least CUED_LENGTH.  ``lead`` is what stands before it in its word,
    ``before`` and ``after`` are the neighbouring words.  Each run has its own
    place, also where the same text stands twice.
    """
    words = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("path"),
        F.split(F.translate("text", "\t\r\n", "   "), " ").alias("words"))

    def may_hold(word: Column) -> Column:
        return (F.length(word) >= MIN_LENGTH) | ((F.length(word) >= CUED_LENGTH) & word.rlike("[0-9]|[A-Z]{%d}" % CUED_LENGTH))

    spots = words.withColumn(
        "at", F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: may_hold(F.get("words", i)))))
    long_words = spots.select(
        "doc_id", "path", F.get("words", F.col("at")).alias("word"), F.get("words", F.col("at") - 1).alias("before"),
        F.get("words", F.col("at") + 1).alias("after"),
        F.concat_ws(" ", F.get("words", F.col("at") - 2), F.get("words", F.col("at") - 1)).alias("two_before"),
        F.aggregate(F.slice("words", 1, F.col("at")), F.lit(0), lambda n, w: n + F.length(w) + 1).alias("word_start"))
    run = r"[A-Za-z0-9+/_-]{%d,}" % CUED_LENGTH
    runs = long_words.withColumn("runs", F.regexp_extract_all("word", F.lit(f"({run})"))).withColumn(
        "parts", F.split("word", run)).where(F.size("runs") > 0)  # parts[i] stands before runs[i]
    steps = F.zip_with("parts", "runs", lambda part, found: F.struct(
        F.length(part).alias("gap"), F.coalesce(found, F.lit("")).alias("found")))
    ends = F.aggregate(steps, F.array(F.lit(0)), lambda n, x: F.concat(
        n, F.array(F.element_at(n, -1) + x["gap"] + F.length(x["found"]))))
    each = runs.withColumn("ends", ends).select("*", F.posexplode("runs").alias("nth", "found")).withColumn(
        "place", F.get("ends", F.col("nth") + 1) - F.length("found"))
    lead = F.substring("word", F.lit(1), F.col("place"))
    found = each.withColumn("lead", lead).where(F.col("found").rlike("[0-9]|^[A-Z]+$") & (
        (F.length("found") >= MIN_LENGTH) | F.concat_ws(" ", "two_before", F.substring("word", F.greatest(F.lit(1), F.col("place") - 63), F.least(
            F.lit(64), F.col("place")))).rlike(_CUED)))
    return found.select(
        "doc_id", "path", (F.col("word_start") + F.col("place")).cast("long").alias("start"), F.col("found").alias("candidate"),
        "lead", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after")).distinct()


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """Three-letter pieces of the most common words of all texts."""
    top = docs.select(F.explode(F.split(F.translate(F.lower("text"), "\t\r\n.,", "     "), " ")).alias("w")).where(
        F.length("w") >= 3).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words).collect()
    return sorted({r["w"][i:i + 3] for r in top if r["w"].isalpha() for i in range(len(r["w"]) - 2)}) or ["the"]


def with_features(found: DataFrame, pieces: list[str]) -> DataFrame:
    """``found`` with a double column for each of FEATURES."""
    c = F.col("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / F.length(c)

    low = F.lower("candidate")
    parts = F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(low, i, F.lit(3)))
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    context = F.concat_ws(" ", "before", "lead")
    flags = {
        "length": F.length(c), "upper": share("[A-Z]"), "lower": share("[a-z]"), "digit": share("[0-9]"), "mark": share("[+/_-]"),
        "shifts": F.regexp_count(c, F.lit("(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])")) / F.length(c),
        "repeats": F.regexp_count(c, F.lit(r"(.)(?=\1)")) / F.length(c),
        "variety": F.size(F.array_distinct(chars)) / F.length(c),
        "hexadecimal": c.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "coverage": F.size(F.filter(parts, lambda p: F.array_contains(F.lit(pieces), p))) / F.size(parts),
        "cue_before": F.col("before").rlike(_CUE), "cue_word": F.col("lead").rlike(_CUE),
        "assigned": context.rlike("[=:]\\s*[\"']?$"), "quoted": F.col("lead").rlike("[\"']$"),
        "link": context.rlike("(?i)https?:|://|@|www"),
        "prose_before": F.col("before").rlike("^\\p{L}+[.,]?$"), "prose_after": F.col("after").rlike("^\\p{L}+[.,]?$"),
        "path_kind": F.col("path").rlike(_SAMPLES), "path_code": F.pmod(F.xxhash64("path"), F.lit(16)),
    }
    return found.select("*", *[flags[f].cast("double").alias(f) for f in FEATURES])


def rule_labels(found: DataFrame) -> DataFrame:
    """Labelled findings: ``label`` 1 where format and context leave no doubt, 0 where they rule a secret out, else null."""
    c, lead = F.col("candidate"), F.col("lead")
    named = lead.rlike(_CUE) | (F.col("before").rlike("^[=:]$") & lead.rlike("^[\"']$"))
    yes = c.rlike("^AKIA[A-Z0-9]{16}$") | (named & c.rlike("[0-9]") & c.rlike("[a-zA-Z]"))
    no = c.rlike("^[0-9-]+$") | c.rlike("^[A-Za-z_/-]+$") | lead.rlike("(?i)@|://|https?:$")
    return found.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """Forest from ``labelled`` (FEATURES, label 0/1), at most ``max_rows`` a label; None unless both labels occur."""
    counts = {r["label"]: r["n"] for r in labelled.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    parts = [labelled.where(F.col("label") == k).sample(False, min(1.0, max_rows / n), SEED) for k, n in sorted(counts.items())]
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(parts[0].unionByName(parts[1]))
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=SEED, featuresCol="features", labelCol="label").fit(
        materialize(rows.select("features", "label"), "forest-rows"))


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: doc_id, start, length, candidate_sha256, score, is_secret.

    ``docs`` has doc_id, text and source (the path).  ``labelled`` are findings
    with FEATURES and a label; without it, ``rule_labels`` labels the
    candidates.  Null ids and texts have no candidates.  Of equal rows one
    counts.  Without findings of both labels all candidates score 1.  Empty
    table: no rows.
    """
    found = materialize(scan(docs), "candidates")
    seen = materialize(with_features(found, dictionary(docs)), "features")
    forest = train(rule_labels(seen) if labelled is None else labelled)
    if forest is None:
        scored = seen.withColumn("score", F.lit(1.0))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(seen)
        scored = forest.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", F.length("candidate").cast("long").alias("length"),
                         F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"), "score",
                         (F.col("score") >= threshold).alias("is_secret"))
