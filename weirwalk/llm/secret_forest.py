"""Secret scans: candidates by pattern, false positives removed by a random forest.

Everything runs on DataFrame functions and the JVM's forest; no Python reaches the executors.

* A candidate is a whole run of letters, digits and ``+ / _ -``, with dots inside (and up to two ``=`` behind), of 16 characters or more; or any value of four
  characters or more, whatever they are, that is assigned to a word for a secret (to the closing quote or white space); or the password of an address.
* Its features: length; character transitions (the mean log-odds of its pairs of letters, as the corpus' own words have them, against chance; changes between
  character classes, and which); shares of digits, capitals and hex digits; distinct characters and entropy; dictionary
  coverage (how many characters belong to runs of letters that are words of the corpus, in two documents or more); path marks (slashes in it,
  a slash, dot or at sign beside it); neighbouring words (a word for a secret before it, a word for an identifier or digest before it), an assignment and quotes;
  a provider's prefix; the form of a reference to a value kept elsewhere (``${NAME}``, ``<name>``, a row of one character).
* The forest learns from labelled findings: templates with generated values, and candidates of the corpus that rules can label. Placeholders and single words
  that are assigned to a word for a secret are taught as false, bare tokens with a provider's prefix as true.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table, text_or_empty

_RUN = "A-Za-z0-9+/_-"
#: Characters of text before and behind a candidate that its features see.
BEFORE, BEHIND = 48, 16
ACCEPTED_FROM = 0.5
TREES, DEPTH = 24, 6
#: The most different labelled findings of the corpus, of each label; those with the smallest hash are taken.
LABELLED_ROWS = 2000
#: Findings that each template is filled into.
PER_TEMPLATE = 60
REPLACEMENT = "[SECRET]"
_MARK, _OTHER_MARK = "\x01", "\x02"

# Words that stand before secrets, and before identifiers and digests.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api key", "access_key", "private_key", "auth", "bearer", "credential", "credentials")
# Behind an assignment to a name that ends in a word for a secret, or in one and up to two more parts. The short conditions come first, for speed.
_KEYED = (
    r"(?<=[=:>\s\"'])(?<=[=:]>?[ \t]{0,4}[\"']?)(?<=(?i:" + "|".join(SECRET_WORDS) + r")(?:[_-][A-Za-z0-9]{1,16}|)(?:[_-][A-Za-z0-9]{1,16}|)[\"']?[ \t]{0,4}:?[=:]>?[ \t]{0,4}"
)
CANDIDATE = "|".join(
    (
        _KEYED + r"[\"'])[^\"'\r\n]{4,}(?=[\"'])",
        _KEYED + r")[^\s\"']{3,}[^\s\"',;.)\]}]",
        r"(?<=:)(?<=://[^\s/:@]{1,64}:)[^\s/@]{4,}(?=@)",
        rf"(?<![{_RUN}])(?<![{_RUN}]\.)(?=(?:[{_RUN}]\.?){{16}})[{_RUN}][.{_RUN}]*[{_RUN}](?:={{1,2}}(?![\w\"']))?",
    )
)
OTHER_WORDS = ("commit", "sha1", "sha256", "md5", "checksum", "digest", "uuid", "revision", "build", "version", "card", "phone", "order", "invoice", "account", "number", "isbn", "example")
# How providers' tokens begin.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "sk_test_", "rk_live_", "AIza", "ya29.", "npm_", "pypi-", "SG.", "hf_")
# What stands in the place of a secret, and single words.
PLACEHOLDERS = (
    "changeme", "change_me", "change-this", "your_password", "your-api-key-here", "your_token_here", "my_secret_value", "insert_token_here", "placeholder", "replace_with_yours", "redacted", "undefined",
    "xxxxxxxx", "XXXXXXXXXXXXXXXXXXXX", "********", "<your-token>", "<password>", "${API_TOKEN}", "{{ secret }}", "$PASSWORD", "%(password)s", "os.environ",
)
PLAIN_WORDS = ("Mountain", "river", "Window", "orange", "Station", "harbour", "Passage", "thunder", "Garden", "morning", "letter", "Winter")
# Labelled findings, with the place of the value. h: 40 hex digits, b: 32 of 64 characters, d: 16 decimal digits,
# u: a UUID, w: words of letters with a number, y: words of letters, v: one word, p: 8 to 15 characters of all kinds, l: 20 letters, j: three dotted parts,
# q: four words with blanks, k: a provider's prefix and 16 or more characters, m: such a prefix and words, x: a placeholder, s: a single word.
TEMPLATES = (
    ('{secret} = "%h"', 1), ("{secret}: %b", 1), ("export {secret}=%b", 1), ("'{secret}': '%h'", 1), ("{secret} %b", 1), ("the {secret} is %h", 1), ('{secret} = "%b"', 1),
    ('{secret} = "%j"', 1), ("{secret}: %j", 1), ("bearer %j", 1), ('github_{secret} = "%b"', 1), ("DB_{secret}=%p", 1), ('{secret} = "%p"', 1), ("{secret}: %p", 1), ("://{other}:%p@db.example.com", 1),
    ('{secret} = "%l"', 1), ("{secret}=%l", 1), ('{secret} = "%q"', 1), ("the %y was", 0), ("of www.example.org/%y for", 0), ("{secret}: %v", 0), ("the {secret} = %v;", 0), ("{other}: %l", 0),
    ("{other} %h", 0), ("{other}: %h", 0), ("{other} %d", 0), ("and then %d the", 0), ("{other} %u", 0), ("of the %u for", 0), ("https://www.example.org/%w/index", 0),
    ("see /usr/share/%w/doc", 0), ("the %w was", 0), ("{secret} %w", 0), ("{secret}: %u", 0), ("write to %w@mail.example.com", 0), ("{other} = %w", 0),
    ("%k", 1), ("see %k and", 1), ("the %k.", 1), ("{other} %k", 1), ("{secret}: %k", 1), ('{secret} = "%k"', 1), ("the %m was", 0), ('{secret} = "%x"', 0), ("{secret}: '%x'", 0), ("{secret}=%x", 0),
    ("DB_{secret}=%x", 0), ('{secret} = "%s"', 0), ("{secret}: '%s'", 0), ("{secret}=%s", 0),
)

_FEATURES = (
    "f_length f_transitions f_prefix f_reference f_changes f_digit_letter f_digits f_capitals f_hex f_distinct f_entropy f_covered f_slashes f_beside f_secret_word f_other_word f_assigned f_quoted f_all_digits f_uuid f_other_chars"
).split()


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, start, secret, before, behind): each candidate of each row, with its number and place (code points from 0) in the text."""
    whole = text_or_empty(F.col(text))
    # One pass marks the candidates in place; the mark itself is another control character meanwhile, which the pattern treats alike.
    marked = F.split(F.regexp_replace(F.translate(whole, _MARK, _OTHER_MARK), F.lit(CANDIDATE), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    found = docs.select(F.col(key), whole.alias("__text"), marked.alias("__parts"), F.monotonically_increasing_id().alias("__row")).filter(F.size("__parts") > 1)
    # Texts that hold the mark are read by the pattern again, so that their candidates keep it.
    odd = F.contains("__text", F.lit(_MARK))
    found = found.select(
        key,
        "__row",
        F.when(odd, F.regexp_extract_all("__text", F.lit(CANDIDATE), F.lit(0))).otherwise(F.filter("__parts", lambda _, i: i % 2 == 1)).alias("__found"),
        F.when(odd, F.split("__text", CANDIDATE)).otherwise(F.filter("__parts", lambda _, i: i % 2 == 0)).alias("__rest"),
    )
    rows = found.select(
        key,
        "__row",
        F.posexplode(
            F.arrays_zip(
                F.col("__found").alias("secret"),
                F.col("__rest").alias("before"),
                F.slice("__rest", F.lit(2), F.size("__found")).alias("behind"),
                # A neighbouring candidate is part of the surroundings.
                F.concat(F.array(F.lit("")), F.col("__found")).alias("previous"),
                F.concat(F.array(F.lit("")), F.col("__rest")).alias("further"),
                F.slice("__found", F.lit(2), F.size("__found")).alias("next"),
            )
        ).alias("n", "at"),
    ).filter(F.col("at.secret").isNotNull())
    until = Window.partitionBy("__row").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.char_length("at.before") + F.char_length("at.secret")).over(until) - F.char_length("at.secret")
    return rows.select(
        key, "n", start.alias("start"), F.col("at.secret").alias("secret"), F.right(F.concat(F.coalesce("at.further", F.lit("")), F.coalesce("at.previous", F.lit("")), "at.before"), F.lit(BEFORE)).alias("before"), F.left(F.concat("at.behind", F.coalesce("at.next", F.lit(""))), F.lit(BEHIND)).alias("behind")
    )


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LETTER_PAIRS = r"(?=([a-z]{2}))"


def transitions(words: DataFrame) -> list[float]:
    """log(26 P(second | first)) of all 26 * 26 pairs of letters over the words of the dictionary, one more of each pair than counted."""
    pairs = words.select(F.explode(F.regexp_extract_all("word", F.lit(_LETTER_PAIRS), F.lit(1))).alias("pair")).groupBy("pair").count()
    counts = {row["pair"]: row["count"] for row in pairs.collect()}
    odds = []
    for first in _LETTERS:
        behind = [counts.get(first + second, 0) + 1 for second in _LETTERS]
        odds += [math.log(26 * n / sum(behind)) for n in behind]
    return odds


def dictionary(docs: DataFrame, text: str = "text", documents: int = 2) -> DataFrame:
    """(word): runs of 3 to 12 letters that stand in so many documents or more, over the whole table, in lower case."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(F.col(text))), F.lit(r"(?<![a-z])[a-z]{3,12}+(?![a-z])"), F.lit(0)))
    return docs.select(F.explode(words).alias("word")).groupBy("word").count().filter(F.col("count") >= documents).select("word")


def _any_word(words: tuple[str, ...], place: Column) -> Column:
    return F.lower(place).rlike(r"(?<![a-z0-9])(" + "|".join(words) + r")(?![a-z0-9])").cast("double")


def with_features(found: DataFrame, words: DataFrame, log_odds: list[float] | None = None) -> DataFrame:
    """Adds the features; `found` has secret, before, behind and a unique id. `log_odds` are the words' `transitions`."""
    odds = F.lit(transitions(words) if log_odds is None else log_odds)
    secret, length = F.col("secret"), F.char_length("secret")
    digits_capitals = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    classes = F.regexp_replace(F.translate(secret, digits_capitals + "abcdefghijklmnopqrstuvwxyz", "0" * 10 + "A" * 26 + "a" * 26), "[^0Aa]", "-")
    collapsed = F.regexp_replace(F.col("__classes"), r"(.)\1+", "$1")
    left = lambda pattern: F.char_length(F.regexp_replace(secret, pattern, ""))
    share = lambda n: n / length
    chars = F.split(secret, "")
    # Entropy from the counts of the characters: few different ones.
    counts = F.transform(F.array_distinct(chars), lambda c: length - F.char_length(F.replace(secret, c, F.lit(""))))
    entropy = F.aggregate(counts, F.lit(0.0), lambda done, n: done - F.when(n > 0, n / length * F.log2(n / length)).otherwise(0.0))
    pairs = F.regexp_extract_all(F.lower(secret), F.lit(_LETTER_PAIRS), F.lit(1))
    pair_odds = F.aggregate("__pairs", F.lit(0.0), lambda done, pair: done + F.get(odds, (F.ascii(pair) - 97) * 26 + F.ascii(F.substring(pair, 2, 1)) - 97))
    parts = found.select("id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(secret), F.lit(r"[a-z]{3,12}"), F.lit(0)))).alias("word"))
    covered = parts.join(words, "word").groupBy("id").agg(F.sum(F.char_length("word")).alias("__covered"))
    made = found.withColumns({"__classes": classes, "__pairs": pairs}).withColumns(
        {
            "f_length": length.cast("double"),
            "f_transitions": F.when(F.size("__pairs") > 0, pair_odds / F.size("__pairs")).otherwise(0.0),
            "f_prefix": secret.rlike("^(" + "|".join(prefix.replace(".", "[.]") for prefix in PREFIXES) + ")[A-Za-z0-9._-]{12}").cast("double"),
            "f_reference": secret.rlike(r"^(\$[A-Za-z_{(]|\{\{|<[^<>]*>$|%\(|(.)\2*$)").cast("double"),
            "f_changes": share(F.char_length(collapsed) - 1),
            "f_digit_letter": share(F.regexp_count(collapsed, F.lit("0(?=[aA])")) + F.regexp_count(collapsed, F.lit("[aA](?=0)"))),
            "f_digits": share(length - left("[0-9]")),
            "f_capitals": share(length - left("[A-Z]")),
            "f_hex": share(length - left("[0-9a-fA-F]")),
            "f_distinct": share(F.size(F.array_distinct(chars))),
            "f_entropy": entropy,
            "f_slashes": (length - left("/")).cast("double"),
            "f_beside": (F.col("before").rlike(r"[/.@]$") | F.col("behind").rlike(r"^[/.@]\w")).cast("double"),
            "f_secret_word": _any_word(SECRET_WORDS, F.col("before")),
            "f_other_word": _any_word(OTHER_WORDS, F.col("before")),
            "f_assigned": F.col("before").rlike(r"[=:]>?\s*[\"']?$").cast("double"),
            "f_quoted": (F.col("before").rlike(r"[\"']$") & F.col("behind").rlike(r"^[\"']")).cast("double"),
            "f_all_digits": secret.rlike("^[0-9]+$").cast("double"),
            "f_uuid": secret.rlike("^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$").cast("double"),
            "f_other_chars": share(length - left(f"[^={_RUN}]")),
        }
    )
    return made.join(covered, "id", "left").withColumn("f_covered", F.coalesce(F.col("__covered") / length, F.lit(0.0))).drop("__classes", "__pairs", "__covered")


def template_findings(spark: SparkSession) -> DataFrame:
    """Labelled findings (secret, before, behind, label) from the templates, with values generated from hashes of their numbers."""
    rows = []
    for number, (template, label) in enumerate(TEMPLATES):
        kind = template[template.index("%") + 1]
        before, behind = template.split("%" + kind)
        rows.append(F.struct(F.lit(number).alias("template"), F.lit(kind).alias("kind"), F.lit(before).alias("before"), F.lit(behind).alias("behind"), F.lit(label).alias("label")))
    each = spark.range(PER_TEMPLATE).select(F.col("id").alias("i"), F.explode(F.array(*rows)).alias("t")).select("i", "t.*")
    seed = F.concat_ws(" ", "template", "i")
    hexed, wide = F.sha1(F.encode(seed, "UTF-8")), F.sha2(F.encode(seed, "UTF-8"), 256)
    pick = lambda words: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(seed), F.lit(len(words))) + 1).cast("int"))
    base = F.translate(F.left(F.base64(F.unhex(wide)), F.lit(32)), "=", "x")
    tail = F.translate(base, "+/", "xK")
    value = (
        F.when(F.col("kind") == "h", hexed)
        .when(F.col("kind") == "b", base)
        .when(F.col("kind") == "d", F.left(F.translate(wide, "abcdef", "123456"), F.lit(16)))
        .when(F.col("kind") == "u", F.concat_ws("-", *[F.substring(wide, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
        .when(F.col("kind") == "p", F.concat(F.left(base, F.lit(4)), pick(("@", "!", "#", "$", "%", "&", "*", "?")), F.substring(base, 5, 3), pick(("", "!", "9?", "#Kd", "^x7@", "&q2Zt", "%%Lw8p"))))
        .when(F.col("kind") == "l", F.left(F.concat(F.regexp_replace(base, "[^A-Za-z]", ""), F.lit("QwzKxTvjHbLpRmNcYdGs")), F.lit(20)))
        .when(F.col("kind") == "j", F.concat_ws(".", F.concat(F.lit("eyJ"), F.left(base, F.lit(17))), F.concat(F.lit("eyJ"), F.translate(base, "+/", "-_")), F.translate(F.base64(F.unhex(hexed)), "+/=", "-_")))
        .when(F.col("kind") == "y", F.concat_ws("_", pick(OTHER_WORDS), pick(("reader", "station", "passage", "window", "report")), pick(("summary", "archive", "release"))))
        .when(F.col("kind") == "v", pick(("required", "optional", "null", "none", "string", "invalid", "true", "false", "self.value", "get_value()", "expired", "missing")))
        .when(F.col("kind") == "q", F.concat_ws(" ", *[F.element_at(F.array(*map(F.lit, ("correct", "horse", "battery", "staple", "river", "lantern", "copper", "window"))), (F.pmod(F.xxhash64(seed, F.lit(k)), F.lit(8)) + 1).cast("int")) for k in range(4)]))
        .when(F.col("kind") == "k", F.when(pick(PREFIXES).rlike("^A[KS]"), F.concat(pick(PREFIXES), F.upper(F.left(tail, F.lit(16))))).otherwise(F.concat(pick(PREFIXES), tail)))
        .when(F.col("kind") == "m", F.concat(pick(PREFIXES), F.concat_ws("_", pick(OTHER_WORDS), pick(("reader", "station", "passage", "window", "report")), pick(("summary", "archive", "release")))))
        .when(F.col("kind") == "x", pick(PLACEHOLDERS))
        .when(F.col("kind") == "s", pick(PLAIN_WORDS))
        .otherwise(F.concat_ws("_", pick(OTHER_WORDS), pick(("reader", "station", "passage", "window", "report")), pick(("summary", "archive", "release")), F.pmod("i", F.lit(100)).cast("string")))
    )
    filled = F.replace(F.replace("before", F.lit("{secret}"), pick(SECRET_WORDS)), F.lit("{other}"), pick(OTHER_WORDS))
    return each.select(value.alias("secret"), filled.alias("before"), "behind", F.col("label").cast("double").alias("label")).filter("secret <> ''")


def rule_labels() -> Column:
    """1 for a random-looking value (one without digits has fewer of the words' pairs of letters than chance) in quotes that is assigned to a word for a secret, 0 for plain numbers, UUIDs, and parts of addresses and runs without
    a digit that have no word for a secret and no assignment before them, else null."""
    assigned = (F.col("f_secret_word") == 1) & (F.col("f_assigned") == 1) & (F.col("f_quoted") == 1) & (F.col("f_entropy") >= 3) & (F.col("f_covered") < 0.5)
    assigned = assigned & (F.col("f_reference") == 0) & ((F.col("f_digits") > 0) | (F.col("f_transitions") <= 0))
    alone = (F.col("f_secret_word") == 0) & (F.col("f_assigned") == 0)
    return F.when(assigned & (F.col("f_other_word") == 0), 1.0).when((F.col("f_all_digits") == 1) | (F.col("f_uuid") == 1) | (alone & ((F.col("f_beside") == 1) | (F.col("f_digits") == 0))), 0.0)


def fit_forest(labelled: DataFrame) -> RandomForestClassificationModel:
    """`labelled`: features and label (0 or 1), a bounded table. The rows are put in one order first, so that a rerun grows the same trees."""
    ordered = labelled.select(*_FEATURES, "label").coalesce(1).sortWithinPartitions("label", *_FEATURES)
    vectors = VectorAssembler(inputCols=_FEATURES, outputCol="features", handleInvalid="keep").transform(ordered)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="sqrt").fit(vectors)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """(key, n, start, length, secret, score, is_secret): every candidate of every row with the forest's share of votes.

    `labelled` adds findings (secret, before, behind, label) to learn from. Null and empty texts have no candidates; repeated rows have their own;
    candidates of rows with null keys keep the null; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    found = candidates(docs, key, text).withColumn("id", F.monotonically_increasing_id())
    words = stored(dictionary(docs, text))
    log_odds = transitions(words)
    featured = stored(with_features(stored(found), words, log_odds))
    taught = template_findings(spark) if labelled is None else template_findings(spark).unionByName(labelled.select("secret", "before", "behind", "label"))
    taught = with_features(taught.withColumn("id", F.monotonically_increasing_id()), words, log_odds).select(*_FEATURES, "label")
    ruled = featured.withColumn("label", rule_labels()).filter("label IS NOT NULL")
    for label in (0, 1):
        sample = ruled.filter(F.col("label") == label).dropDuplicates(["secret", "before", "behind"]).orderBy(F.xxhash64("secret", "before", "behind"), "secret", "before", "behind").limit(LABELLED_ROWS)
        taught = taught.unionByName(sample.select(*_FEATURES, "label"))
    forest = fit_forest(stored(taught))
    scored = forest.transform(VectorAssembler(inputCols=_FEATURES, outputCol="features", handleInvalid="keep").transform(featured))
    score = vector_to_array("probability")[1]
    return scored.select(key, F.col("n"), "start", F.char_length("secret").alias("length"), "secret", score.alias("score"), (score >= ACCEPTED_FROM).alias("is_secret"))


def redacted_documents(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the accepted findings cut out of the text by their places; n_chars, if there is one, follows. No row is dropped.

    A place holds for all rows of its key, null or not, so rows with one key must have one text (as when the key is a digest of the text).
    """
    spans = found.filter("is_secret").groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("__spans"))
    joined = docs.join(spans.hint("merge"), F.col(key).eqNullSafe(F.col("__key")), "left")
    # What is done so far, and the place behind the last finding.
    begin = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(F.col(text), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.struct(F.concat(state["done"], between, F.lit(REPLACEMENT)).alias("done"), (span["start"] + span["length"]).alias("at"))

    clean = F.aggregate("__spans", begin, step, lambda state: F.concat(state["done"], F.substring(F.col(text), (state["at"] + 1).cast("int"), F.char_length(text))))
    hit = F.col("__spans").isNotNull()
    out = joined.withColumn(text, F.when(hit, clean).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def redacted_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, each row scanned and its accepted findings replaced; rows are told apart by their texts, so keys may repeat or be null."""
    named = docs.withColumn("__digest", F.md5(text))
    return redacted_documents(named, scan_secrets(named, "__digest", text), "__digest", text).drop("__digest")


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
