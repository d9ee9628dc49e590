"""Secret scanning with a random forest that removes false positives, in DataFrame and pyspark.ml functions only.

Candidates are values of at least ``SHORT`` characters other than blanks and quotes that are assigned to a credential's
name (also without a digit; outside quotes they end before ``,;`` and brackets too), runs of at least ``LEAST`` characters of letters, digits and
``+/_-`` that hold a digit, with up to four more parts after dots and closing ``=`` (signed and sealed tokens have three and five parts), and runs of at least ``SHORT``
letters, digits and marks that hold a digit, a capital and a small letter. The leftmost wins; at one place the first kind named. The forest
looks at their length, the shares and changes of character kinds, how many different characters they have, how much
of them is words of a dictionary counted over all texts, the path (here: a column that says where the text is from)
and the words beside them. It is trained on labelled findings, at most ``SAMPLE`` of each label, and scores
every candidate of every text. Labelled findings that are no candidates are judged and returned too.

Defined cases: null and empty texts have no candidates; repeated rows have theirs each; without findings of both
labels every score is the share of true ones (0 without labels); a null path is a path like any other; of several labels of one
place the largest counts; a label whose place is in no text has no row; a run without end is one candidate, whatever its length.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.personal import matches
from panelspark.llm.tables import col, fresh
from panelspark.workspace import stored

LEAST, SHORT, CONTEXT, BUCKETS = 16, 8, 40, 32
DICTIONARY, SAMPLE = 4000, 20_000
TREES, DEPTH = 30, 6
NAMES = r"(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|credentials?)"
#: Cheap tests of a place come before the look back for a name.
ASSIGNED = (
    r"(?<=[=:\s\"'`])(?=[^\s\"'`]{%d})(?<=[=:]\s{0,3}[\"'`]?)(?<=(?i:%s)[\"'`\])]{0,2}\s{0,3}[=:]\s{0,3}[\"'`]?)" % (SHORT, NAMES)
    + r"(?:(?<=[\"'`])[^\s\"'`]{%d,}+|[^\s\"'`,;<>(){}\[\]]{%d,}+)" % (SHORT, SHORT)
)
LONG = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{%d,}+(?:\.[A-Za-z0-9+/_-]++){0,4}+={0,2}+" % LEAST
MIXED = "".join(
    [r"(?<![A-Za-z0-9!@#$%^&*~+/_-])", *(r"(?=[A-Za-z0-9!@#$%%^&*~+/_-]*?%s)" % k for k in ("[0-9]", "[A-Z]", "[a-z]")), r"[A-Za-z0-9!@#$%%^&*~+/_-]{%d,}+" % SHORT]
)
CANDIDATE = f"{ASSIGNED}|{LONG}|{MIXED}"
FEATURES = (
    "length digits upper lower marks changes letter_to_digit digit_to_letter upper_to_lower distinct hexadecimal longest_run coverage path before after quoted"
).split()


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``id, path, start, end, found, before, after, near``: a row for each candidate; near are the characters in front."""
    text = F.coalesce(col(text_col), F.lit(""))
    (row,) = fresh(docs.columns, "_whole")
    each = docs.select(col(id_col).alias("id"), col(path_col).cast("string").alias("path"), text.alias(row)).select(
        "id", "path", row, F.explode(matches(col(row), CANDIDATE, "[0-9=:]")).alias("c")
    )
    return _framed(each, row)


def _framed(each: DataFrame, row: str) -> DataFrame:
    """Findings ``c`` with what stands beside them in the text ``row``."""
    begin = F.greatest(F.col("c.start") - CONTEXT, F.lit(0))
    near = F.substring(col(row), begin + 1, F.col("c.start") - begin)
    after = F.substring(col(row), F.col("c.end") + 1, F.lit(CONTEXT))
    return each.select(
        "id", "path", "c.start", "c.end", "c.found", near.alias("near"),
        F.lower(F.regexp_extract(near, r"(\p{L}+)\P{L}*$", 1)).alias("before"), F.lower(F.regexp_extract(after, r"^\P{L}*(\p{L}+)", 1)).alias("after"),
    )


def labelled_elsewhere(docs: DataFrame, labels: DataFrame, found: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """Rows like those of ``candidates`` for labelled places where none begins: up to the next blank or quote."""
    (row,) = fresh(docs.columns, "_whole")
    others = stored(labels.select("id", F.col("start").cast("int").alias("start")).join(found.select("id", "start"), ["id", "start"], "left_anti").distinct(), "others")
    texts = docs.select(col(id_col).alias("id"), col(path_col).cast("string").alias("path"), F.coalesce(col(text_col), F.lit("")).alias(row))
    value = F.regexp_extract(F.substring(col(row), F.col("start") + 1, F.length(row)), r"^[^\s\"'`]++", 0)
    placed = texts.join(others, "id").filter("start >= 0").select("id", "path", row, "start", value.alias("value")).filter("value <> ''")
    place = F.struct("start", (F.col("start") + F.length("value")).alias("end"), F.col("value").alias("found"))
    return _framed(placed.select("id", "path", row, place.alias("c")), row)


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The ``DICTIONARY`` most frequent words of three letters and more, counted over all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(col(text_col), F.lit(""))), r"[^a-z]+")).alias("word"))
    counts = words.filter(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n"))
    return stored(counts.orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word"), "dictionary")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with a column for each feature."""
    x, n = F.col("found"), F.length("found").cast("double")
    count = lambda pattern: F.regexp_count(x, F.lit(pattern)).cast("double")
    runs = F.filter(F.split(F.lower(x), r"[^a-z]+"), lambda r: F.length(r) >= 3)
    values = found.select("found").distinct()
    covered = (
        values.select("found", F.explode(runs).alias("word")).join(F.broadcast(words), "word")  # at most DICTIONARY words
        .groupBy("found").agg(F.sum(F.length("word")).alias("covered"))
    )
    bucket = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit(""))), F.lit(BUCKETS)).cast("double")
    shapes = {
        "length": n, "digits": count("[0-9]") / n, "upper": count("[A-Z]") / n, "lower": count("[a-z]") / n, "marks": count("[^A-Za-z0-9]") / n,
        "changes": count("(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])") / n,
        "letter_to_digit": count("(?<=[A-Za-z])(?=[0-9])") / n, "digit_to_letter": count("(?<=[0-9])(?=[A-Za-z])") / n,
        "upper_to_lower": count("(?<=[A-Z])(?=[a-z])") / n, "distinct": F.size(F.array_distinct(F.split(x, ""))).cast("double"),
        "hexadecimal": x.rlike("^[0-9a-fA-F]+$").cast("double"),
        "longest_run": F.array_max(F.transform(F.split(x, "[^A-Za-z]+"), lambda r: F.length(r))).cast("double"),
        "coverage": F.coalesce(F.col("covered"), F.lit(0)) / n,
    }
    shaped = stored(values.join(covered, "found", "left").select("found", *[c.alias(k) for k, c in shapes.items()]), "shapes")
    beside = {
        "path": bucket(F.col("path")), "before": bucket(F.col("before")), "after": bucket(F.col("after")),
        "quoted": F.col("near").rlike("[\"'`]$").cast("double"),
    }
    return found.select("id", "start", "end", "found", *[c.alias(k) for k, c in beside.items()]).join(shaped, "found")


def forest(labelled: DataFrame, seed: int = 7):
    """The fitted forest of featured findings with a column ``label`` (1: a secret), or the share of true ones."""
    counts = {int(r["label"]): r["n"] for r in labelled.filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return 1.0 if 1 in counts else 0.0
    part = lambda k: labelled.filter(F.col("label") == k).orderBy(F.xxhash64("found", "id", "start"), "id", "start").limit(SAMPLE)
    sample = stored(part(0).union(part(1)).withColumn("label", F.col("label").cast("double")), "findings")
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample)
    return RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed).fit(assembled)


def scored(featured: DataFrame, model) -> DataFrame:
    """The findings with ``score``, the forest's share of votes for a secret."""
    if isinstance(model, float):
        return featured.withColumn("score", F.lit(model))
    voted = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(featured))
    return voted.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))


def assigned(near: Column) -> Column:
    """A labelling rule where no one labelled findings: 1 for a quoted value assigned to a credential's name, 0 for
    one that follows anything else and no sign of assignment; null otherwise."""
    names = r"(?i)(token|secret|passw(or)?d|api[_-]?key|access[_-]?key|credential)\W{0,3}\s*[=:]\s*[\"'`]?$"
    return F.when(near.rlike(names), 1).when(~near.rlike(r"[=:]\s*[\"'`]?$"), 0)


def findings(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``id, start, end, found, label, score`` of all candidates. ``labels``: ``id, start, label`` of findings
    that were looked at; without it the rule of ``assigned`` labels them."""
    found = stored(candidates(docs, id_col, text_col, path_col), "candidates")
    if labels is None:
        labels = found.select("id", "start", assigned(F.col("near")).alias("label")).filter("label IS NOT NULL")
    else:
        found = found.unionByName(stored(labelled_elsewhere(docs, labels, found, id_col, text_col, path_col), "labelled"))
    labels = labels.groupBy("id", "start").agg(F.max("label").cast("int").alias("label"))
    featured = stored(features(found, dictionary(docs, text_col)).join(labels, ["id", "start"], "left"), "featured")
    return scored(featured, forest(featured)).select(F.col("id").alias(id_col), "start", "end", "found", "label", "score")
