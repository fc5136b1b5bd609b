"""Secret scan: rules find candidate words, and a random forest removes the false positives.

All of it is DataFrame functions and Spark's own forest. Features are the candidate's length, its character transitions,
how much of it the words of the corpus cover, path-like parts of it and of the document's path, and the words next to it
on both sides. The forest is trained from labelled findings: those of `secret_examples`, and given ones or those of the
corpus whose form leaves no doubt.

A word is a candidate if it looks like an issued key, assigns a value to a name of a secret, holds a URL's password, stands within
two words behind such a name, or has a digit and at least LONG characters. Other words are no candidates: a short
word, or one without digits, is no secret where nothing names it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, written
from ledgerlake.llm.secret_examples import FALSE, REAL

#: Labelled findings of each label that the forest is trained on, its trees and their depth, and the score of a finding.
SAMPLE, TREES, DEPTH, THRESHOLD = 3000, 24, 6, 0.5
#: Findings of the corpus that one of the examples weighs as much as.
EXAMPLE_WEIGHT = 10.0
#: Characters of a word with a digit from which it is a candidate.
LONG = 12

# fixed values: prefixes of issued keys, names of secrets, marks of stand-ins
KEY = (
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}"
    r"|(?:gh[pousr]_|github_pat_|glpat-|sk_live_|rk_live_|sk-|npm_|xox[abprs]-|AIza|eyJ)[A-Za-z0-9_\-./+=]{16,})"
)
#: A hyphenated part that reads like a word; issuers' own parts do not count.
WORDY = r"-(?!(?:proj|ant|live|test|admin|svcacct)-)[A-Za-z][a-z]{2,}(?=-|$)"
#: A name stands free of letters and digits: behind a mark, an underscore or a hyphen, or in a name that changes case.
NAME = (
    r"(?:(?<![A-Za-z0-9])(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?(?![A-Za-z])"
    r"|(?<=[a-z0-9])(?:Password|Passwd|Passphrase|Pwd|Secret|Token|ApiKey|AccessKey|Credential)s?(?![a-z]))"
)
ASSIGNED = NAME + r"(?:[_\-.][A-Za-z0-9_\-.]*)?[\"']?(?:=|:)[\"']?[^\x20\x09-\x0D\"']{6,}"
#: A URL's user and password; the last group is the password.
LOGIN = r"[A-Za-z][A-Za-z0-9+.\-]*://[^\x20\x09-\x0D/?#:@]*:([^\x20\x09-\x0D/]+)@"
#: Forms that make a word a candidate by itself. Neither these nor NAME match white space, so a text has one if a word has.
FORM = f"{KEY}|{ASSIGNED}|{LOGIN}"
#: A word of running text.
PROSE = r"^[a-z]+[.,;!?]?$"
STAND_IN = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxx|\*\*\*|<.*>|\$\{|1234567|abcdef"
#: Words of the dictionary at most: those of letters that most documents hold. And words that it has on every corpus.
DICTIONARY_SIZE = 50_000
COMMON = (
    "the and for with that this from have not are was you all can has will one about out use new more page home file data "
    "name user test mail info time date type list index version image main default static public content system server "
    "config admin local string value class code table number error report update release build model service required none basic "
    "expired optional bearer include true false see below unit never hidden word words eight letters door wrong correct invalid missing "
    "empty null must today click change often split into garden love kind people protection managers strong each recipes agents there "
    "example sample dummy placeholder password secret token"
).split()

FEATURES = (
    "length", "digits", "letter_to_digit", "digit_to_letter", "to_upper", "to_lower", "vowel_to_consonant",
    "marks", "coverage", "slashes", "dots", "at_sign", "path_hint", "named", "assigned", "stand_in_near", "prose_before", "prose_after",
)


def _ratio(word: Column, pattern: str) -> Column:
    return F.regexp_count(word, F.lit(pattern)) / F.greatest(F.length(word), F.lit(1))


def may_hold(text: Column) -> Column:
    """A cheap test that every text with a candidate passes."""
    return F.coalesce(text.rlike(rf"[0-9=:]|{NAME}|{KEY}"), F.lit(False))


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY_SIZE) -> DataFrame:
    """(part): words of 3 to 20 letters in small letters, the `size` that most documents hold, and COMMON; a stored table.

    All documents are counted; the size is what bounds the table. A word must stand in
    two documents at least, and what a name assigns is not counted, or a secret of letters would cover itself.
    """
    space = r"[\x20\x09-\x0D]"
    assigned = NAME + rf"[\"']?{space}{{0,3}}[=:]{space}{{0,3}}[^\x20\x09-\x0D]+"
    plain = F.when(F.col(text).rlike(NAME), F.regexp_replace(text, assigned, " ")).otherwise(F.col(text))
    letters = F.regexp_extract_all(plain, F.lit(r"(?<![^\x20\x09-\x0D(\"'])[A-Za-z]{3,20}(?=[.,;:!?)\"']?(?:[\x20\x09-\x0D]|$))"), F.lit(0))
    words = docs.select(F.explode(F.array_distinct(F.transform(letters, F.lower))).alias("part"))
    most = words.groupBy("part").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "part").limit(size).select("part")
    # literals: rows of a Python list would start Python workers, which then stay in every executor's memory
    common = docs.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, COMMON))).alias("part"))
    return written(most.unionByName(common).distinct(), "secret-dictionary")


def with_coverage(found: DataFrame, known: DataFrame) -> DataFrame:
    """found, a written table of candidates, with `coverage`: the share of the secret's characters in words of the dictionary.

    Parts of a secret are its runs of letters, cut where small letters turn to capitals.
    """
    found = found.withColumn("_id", F.monotonically_increasing_id())
    parts = found.select("_id", F.explode(F.regexp_extract_all("secret", F.lit(r"[A-Z]?[a-z]+|[A-Z]+"), F.lit(0))).alias("part"))
    # at most DICTIONARY_SIZE short words
    held = parts.filter(F.length("part") >= 3).withColumn("part", F.lower("part")).join(F.broadcast(known), "part")
    covered = held.groupBy("_id").agg(F.sum(F.length("part")).alias("_covered"))
    share = F.coalesce("_covered", F.lit(0)) / F.greatest(F.length("secret"), F.lit(1))
    return found.join(covered, "_id", "left").withColumn("coverage", share).drop("_id", "_covered")


def candidates(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """docs without text, a row for each candidate word: word (its number from 0), token, secret, kind and all FEATURES but coverage."""
    words = F.col("_words")

    def hit(w: Column, i: Column) -> Column:
        near = [F.coalesce(F.get(words, i + k), F.lit("")) for k in (-2, -1, 1)]
        behind_name = F.col("_named") & w.rlike(r"[\p{L}\p{N}]") & (near[0].rlike(NAME) | near[1].rlike(NAME))
        is_one = ((F.length(w) >= LONG) & w.rlike("[0-9]")) | (F.col("_formed") & w.rlike(FORM)) | behind_name
        return F.when(is_one, F.struct(i.cast("long").alias("word"), w.alias("token"), near[0].alias("before2"), near[1].alias("before"), near[2].alias("after")))

    keep = [c for c in docs.columns if c not in (text, "_words", "_named", "_formed", "_hit")]
    # most texts hold no name and no form: their words are spared the patterns, each of which copies every word it tests
    whole = {"_words": F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), "_named": F.col(text).rlike(NAME), "_formed": F.col(text).rlike(FORM)}
    found = (
        docs.filter(may_hold(F.col(text)))
        .withColumns(whole)
        .select(*keep, F.explode(F.filter(F.transform(words, hit), lambda x: x.isNotNull())).alias("_hit"))
        .select(*keep, "_hit.*")
    )
    core = F.regexp_replace("token", r"^[\"'(<\[{]+|[^A-Za-z0-9=+/_\-]+$", "")
    behind = F.regexp_extract(core, NAME + r"(?:[_\-.][A-Za-z0-9_\-.]*)?[\"']?(?:=|:)[\"']?(.+)$", 1)
    login = F.col("token").rlike(LOGIN)
    value = F.when(login, F.regexp_extract("token", LOGIN, 1)).when(core.rlike(ASSIGNED), behind).otherwise(core)
    before = F.concat_ws(" ", "before2", "before")
    named = F.col("token").rlike(ASSIGNED) | before.rlike(NAME) | login
    hint = r"(?i)(?:^|[/_.-])(?:test|tests|example|examples|doc|docs|sample|fixture|mock)"
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    secret = F.col("secret")
    flags = lambda c: c.cast("double")
    found = found.withColumn("secret", value).withColumns({
        "length": F.length(secret).cast("double"),
        "digits": _ratio(secret, "[0-9]"),
        "letter_to_digit": _ratio(secret, "[A-Za-z](?=[0-9])"),
        "digit_to_letter": _ratio(secret, "[0-9](?=[A-Za-z])"),
        "to_upper": _ratio(secret, "[a-z](?=[A-Z])"),
        "to_lower": _ratio(secret, "[A-Z](?=[a-z])"),
        "vowel_to_consonant": _ratio(secret, "(?i)[aeiou](?=[b-df-hj-np-tv-z])"),
        "marks": _ratio(secret, "[^A-Za-z0-9]"),
        "slashes": F.regexp_count(secret, F.lit(r"[/\\]")).cast("double"),
        "dots": F.regexp_count(secret, F.lit(r"\.")).cast("double"),
        "at_sign": flags(F.contains(secret, F.lit("@"))),
        "path_hint": flags(secret.rlike(hint) | where.rlike(hint)),
        "named": flags(named),
        "assigned": flags(F.col("token").rlike(ASSIGNED) | F.col("before").rlike(r"^[=:]|[=:]$") | login),
        "stand_in_near": flags(secret.rlike(STAND_IN) | F.regexp_replace(before, r"[^ ]*@[^ ]*", "").rlike(STAND_IN)),
        "prose_before": flags(F.col("before").rlike(PROSE)),
        "prose_after": flags(F.col("after").rlike(PROSE)),
        "kind": F.when(F.col("token").rlike(KEY), "issued_key").when(named, "named_value").otherwise("long_word"),
    })
    return found.drop("before2", "before", "after")


def certain_label(found: DataFrame) -> Column:
    """1 for forms that are secrets without doubt, 0 for those that are none, null for all others."""
    secret = F.col("secret")
    plain = secret.rlike(r"^[0-9.,:/+()\-]+$|^[^@]+@[^@]+\.[A-Za-z]+$|^(?:https?|ftp)://|^[A-Za-z]+[0-9]{1,4}$")
    # behind a name or a sign of assignment, and as a URL's user, the same forms are secrets as well
    plain = plain & (F.col("named") == 0) & (F.col("assigned") == 0) & ~secret.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*@")
    random = secret.rlike(r"^[A-Za-z0-9_\-./+=]{12,}$") & secret.rlike("[0-9]") & secret.rlike("[A-Za-z]")
    stand_in = secret.rlike(STAND_IN) | (F.col("stand_in_near") > 0)
    return (
        F.when(stand_in | plain, 0)
        .when((F.col("kind") == "issued_key") & secret.rlike("[0-9]") & ~secret.rlike(WORDY), 1)
        .when((F.col("kind") == "named_value") & (F.col("assigned") > 0) & random & (F.col("coverage") < 0.3), 1)
    )


def examples(spark: SparkSession, known: DataFrame) -> DataFrame:
    """The candidates of the examples, with `label`."""
    lines = [F.struct(F.lit(line).alias("text"), F.lit(secret).alias("real")) for line, secret in (*REAL, *((line, "") for line in FALSE))]
    found = written(candidates(spark.range(1).select(F.explode(F.array(*lines)).alias("line")).select("line.*")), "secret-examples")
    return with_coverage(found, known).withColumn("label", (F.col("secret") == F.col("real")).cast("int")).drop("real")


def train(labelled: DataFrame, words: DataFrame, sample: int = SAMPLE, seed: int = 7) -> RandomForestClassificationModel:
    """A forest from candidates with a `label`, at most `sample` of each, and the examples, which meet the dictionary `words`.

    Those of the smallest hashes of token and features are taken, so reruns agree. Equal
    findings count once.
    """
    known = labelled.filter("label is not null").select("token", *FEATURES, F.col("label").cast("double").alias("label"))
    known = known.withColumn("at", F.xxhash64("token", *FEATURES)).dropDuplicates(["at", "label"])
    parts = [written(known.filter(F.col("label") == k).orderBy("at").limit(sample), "secret-labels") for k in (0.0, 1.0)]
    stored = examples(labelled.sparkSession, words).select(*FEATURES, F.col("label").cast("double").alias("label"), F.lit(EXAMPLE_WEIGHT).alias("weight"))
    rows = parts[0].union(parts[1]).select(*FEATURES, "label", F.lit(1.0).alias("weight")).union(written(stored, "secret-labels"))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.8, weightCol="weight").fit(rows)


def scored(found: DataFrame, forest: RandomForestClassificationModel) -> DataFrame:
    """found with `score`."""
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    return forest.transform(rows).withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, path_col: str | None = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, word, kind, secret and score of every finding in every whole text.

    `labelled` holds candidates with a label; by default those of `docs` that are
    certain are taken. Null and empty texts have no findings. Repeated
    rows are scanned each. Only the named columns are read.
    """
    path = [F.col(path_col).cast("string").alias("path")] if path_col else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *path)
    known = dictionary(rows)
    found = written(with_coverage(written(candidates(rows, path="path" if path else None), "secret-words"), known), "secret-candidates")
    forest = train(found.withColumn("label", certain_label(found)) if labelled is None else labelled, known)
    return scored(found, forest).filter(F.col("score") >= THRESHOLD).select("doc_id", "word", "kind", "secret", "score")


def _masked(text: Column, masks: Column) -> Column:
    """text with the secret of each masked word, found by its number, replaced by its kind; all else stays, white space too."""
    space = r"[\x20\x09-\x0D]*"
    pieces = F.regexp_extract_all(text, F.lit(space + WORD), F.lit(0))

    def mask(piece: Column, i: Column) -> Column:
        m = F.try_element_at(masks, i.cast("long"))
        return F.coalesce(F.replace(piece, m["secret"], F.concat(F.lit("["), m["kind"], F.lit("]"))), piece)

    return F.concat(F.array_join(F.transform(pieces, mask), ""), F.regexp_extract(text, rf"({space})$", 1))


def redact(docs: DataFrame, labelled: DataFrame | None = None, path_col: str | None = "source", text_col: str = "text") -> DataFrame:
    """docs with every secret in the text replaced by its kind in brackets; all rows and columns stay.

    A secret is replaced in the word in which it was found, whatever its length. Null, empty and blank texts stay as
    they are, texts may be of any length, and an empty table stays empty.
    Only texts that pass the cheap test are joined with their findings, by a hash of text and path.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    suspect = may_hold(F.col(text_col))
    key = F.xxhash64(F.col(text_col), path)
    texts = docs.filter(suspect).select(key.alias("_key"), F.col(text_col).alias("text"), path.alias("path"))
    words = written(
        candidates(texts, path="path").dropDuplicates(["_key", "word"]), "secret-words"
    )
    known = dictionary(docs.select(F.col(text_col).alias("text")))
    found = written(with_coverage(words, known), "secret-candidates")
    forest = train(found.withColumn("label", certain_label(found)) if labelled is None else labelled, known)
    real = scored(found, forest).filter(F.col("score") >= THRESHOLD).filter("secret != ''")
    mask = F.struct("word", F.struct("secret", "kind"))
    masks = written(real.groupBy("_key").agg(F.map_from_entries(F.collect_list(mask)).alias("_masks")), "secret-masks")
    hidden = F.when(F.col("_masks").isNull(), F.col(text_col)).otherwise(_masked(F.col(text_col), F.col("_masks")))
    with_key = docs.filter(suspect).withColumn("_key", key)
    changed = with_key.join(masks, "_key", "left").withColumn(text_col, hidden).select(*docs.columns)
    return docs.filter(~suspect).unionByName(changed)
