"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more of ``[A-Za-z0-9+/_-]`` with a digit in it, or the whole
value, of any length and alphabet, that ``=`` or ``:`` assigns to a credential name (``NAME``): up to its closing
quote, or to the next blank.  A run inside such a value is a finding of its own.
Its features: length; character transitions (how often a capital, small letter or digit
follows each other kind, different characters); dictionary coverage (the share of its characters that
the words of the corpus cover, by a join of its pieces of one case with a dictionary table); path (depth, test or example folders, numbers in the
source's name); neighbouring words (credential and example words before it, an assignment sign,
dictionary words on either side).  The forest is trained on labelled findings
and judges every candidate.

``secret_labels`` makes labelled findings: secrets and decoys of stated forms in places of the corpus; the registered query
trains on them.  ``known_format`` labels the candidates themselves where neither they nor a labelled table are at hand: true for formats that are
secrets by construction (issued keys, private keys, values assigned to credential names), false for
sure decoys (phone, card, date, version, UUID and path forms), NULL for the rest, which the
forest judges but does not learn from.  Training takes at most ``MAX_LABELLED`` findings (those of the least hash); the
dictionary is counted over all documents and all candidates are judged.

DataFrame, SQL and Spark ML functions only; no Python runs on the executors.

Defined results: NULL or empty texts have no candidates; NULL paths have depth 0; every
occurrence is a finding of its own, so repeated rows repeat theirs; without labelled findings of both
kinds nothing can be learned, and all candidates are reported with a NULL score; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import written

RUN = "[A-Za-z0-9+/_-]"
SHORTEST = 12
BEFORE, AFTER = 48, 24                  # characters of context
DICTIONARY = 0.001                      # share of the documents that have a word of the dictionary
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 24, 6, 10
CREDENTIAL = "(?i)(passw|pwd|secret|token|credential|auth|api.?key|access.?key|private.?key)"
EXAMPLE = "(?i)(example|sample|dummy|test|placeholder|fake|xxxx|version|phone|card)"
# Credential names as in db_password, aws_secret_access_key or "apiKey", and the sign behind them.
NAME = (r"(?:passw|passphrase|pwd|secret|token|credential|auth(?!ors?(?![a-z]))|(?:api|access|private)[ ._-]?key)[A-Za-z0-9_-]*")
SIGN = "[\"'`]?\\]?\\s*[:=]{1,3}>?\\s*"
# Groups: lead, quote, quoted value, what follows it; or the bare value, what follows it. A quoted value is only
# looked at, so that assignments inside a stray pair of quotes are found too.
ASSIGNMENT = (r"(?is)(?<![\w-])((?:(?=[\w-]*?" + NAME + r")[\w-]++|[\w-]*+(?<=api|access|private)[ .]key[\w-]*+)" + SIGN + ")"
              + r"""(?:(["'`])(?=((?:(?!\2)[^\\]|\\.)++)(\2.{0,""" + str(AFTER - 1) + r"""}))|["'`]?+([^\s"'`]\S*+)(?=(.{0,""" + str(AFTER) + "})))")
KEY_FORMATS = "^(?:" + "|".join([
    "(?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{16,}", "gh[pousr]_[A-Za-z0-9]{36,}", "github_pat_[A-Za-z0-9_]{22,}", "glpat-[A-Za-z0-9_-]{20,}",
    "[sr]k_(?:live|test)_[A-Za-z0-9]{10,}", "sk-[A-Za-z0-9_-]{20,}", "xox[abeoprs]-[A-Za-z0-9-]{10,}", "AIza[A-Za-z0-9_-]{35}",
    "npm_[A-Za-z0-9]{36}", r"eyJ[A-Za-z0-9_-]{9,}(?:\.[A-Za-z0-9_-]+){0,4}"]) + r")\z"
_WORD = "(?:[A-Z]?[a-z]+|[0-9]{1,4})(?:[_-](?:[A-Z]?[a-z]+|[0-9]{1,4}))*"
DECOYS = "^(?:" + "|".join([
    r"\+?[0-9](?:[/_-]?[0-9]){0,18}",                                                   # phones, cards, dates
    "[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2}(?:[0-9-]{0,6})Z?",                       # times
    "(?i:v|ver|version|release|build|rc)[_-]?[0-9]+(?:[_-][0-9]+)*(?:[_-]?(?:alpha|beta|rc)[0-9]*)?",
    "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",                             # UUIDs
    f"/?(?:{_WORD}/)+(?:{_WORD})?"]) + r")\z"                                            # paths of words and numbers
PLACEHOLDER = "(?i)(example|placeholder|dummy|changeme|xxxx)"
_KINDS = {"up": "[A-Z]", "low": "[a-z]", "dig": "[0-9]", "sign": "[^A-Za-z0-9]"}


def _runs(docs: DataFrame) -> DataFrame:
    """Candidates by form. The text is cut in front of every one, in one pass; a candidate has
    its whole length, only the context around it is bounded."""
    cut = f"(?<!{RUN})(?={RUN}*[0-9])(?={RUN}{{{SHORTEST},}})"
    parts = docs.select("id", "path", F.split("text", cut, -1).alias("parts")).where("size(parts) > 1")
    starts = F.aggregate("parts", F.array(F.lit(0).cast("long")),
                         lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x))))
    rows = parts.withColumn("starts", starts).select(
        "id", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda k: F.struct(
            F.element_at("starts", k + 1).alias("start"), F.right(F.element_at("parts", k), F.lit(BEFORE)).alias("before"),
            F.element_at("parts", k + 1).alias("rest")))).alias("c"))
    found = F.regexp_extract("c.rest", f"^{RUN}+", 0)
    return rows.select("id", "path", "c.start", "c.before", found.alias("found"),
                       F.substring(F.col("c.rest"), F.length(found) + 1, F.lit(AFTER)).alias("after"))


def _assigned(docs: DataFrame) -> DataFrame:
    """Candidates by place: values assigned to a credential name.  Splitting by the
    assignment gives the text between the matches, extracting it the matches."""
    def group(k: int) -> Column:
        return F.regexp_extract_all("text", F.lit(ASSIGNMENT), F.lit(k))

    parts = docs.where(F.col("text").rlike(ASSIGNMENT)).select(
        "id", "path", F.split("text", ASSIGNMENT, -1).alias("parts"),
        F.arrays_zip(group(0).alias("whole"), group(3).alias("quoted"), group(4).alias("behind"),
                     group(5).alias("bare"), group(6).alias("after")).alias("hits"))
    # Characters up to the end of each match.
    ends = F.aggregate(F.arrays_zip(F.col("parts").alias("part"), F.col("hits.whole").alias("whole")), F.array(F.lit(0).cast("long")),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x["part"]) + F.length(F.coalesce(x["whole"], F.lit(""))))))
    rows = parts.withColumn("ends", ends).select("id", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("hits")), lambda k: F.struct(
        F.element_at("hits", k).alias("hit"), F.element_at("ends", k + 1).alias("end"),
        F.right(F.element_at("parts", k), F.lit(BEFORE)).alias("between")))).alias("c"))
    hit = F.col("c.hit")
    lead = F.left(hit["whole"], F.length(hit["whole"]) - F.length(hit["bare"]))
    values = rows.select("id", "path", (F.col("c.end") - F.length(hit["bare"])).alias("start"),
                         F.right(F.concat("c.between", lead), F.lit(BEFORE)).alias("before"),
                         F.concat(hit["quoted"], hit["bare"]).alias("found"), F.concat(hit["behind"], hit["after"]).alias("after"))
    # A value that is a candidate by form is in the other list already.
    return values.where(~(F.col("found").rlike(f"^{RUN}{{{SHORTEST},}}\\z") & F.col("found").rlike("[0-9]")))


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """(id, path, start, before, found, after); ``start`` counts characters from 1."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"),
                        F.concat(F.lit(" "), F.col(text_col).cast("string")).alias("text"))
    return _runs(texts).unionByName(_assigned(texts))


def dictionary(docs: DataFrame, text_col: str, share: float = DICTIONARY) -> DataFrame:
    """(word): the lower-case words of three or more letters, of any alphabet, that stand in two documents
    and in ``share`` of them at least.  The share bounds the table whatever the number of
    documents: by the words of an average document over ``share``."""
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![\p{L}\p{N}+/_-])\p{L}{3,}(?![\p{L}\p{N}+/_-])"), F.lit(0))
    least = max(2, math.ceil(share * docs.count()))
    counted = docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return written(counted.where(F.col("n") >= least).select("word"), "secret-words")


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")


def features(found: DataFrame, words: DataFrame) -> tuple[DataFrame, list[str]]:
    """``found`` with the feature columns, and their names.  ``words`` is a
    ``dictionary``."""
    rows = written(found.withColumn("_llm_row", F.monotonically_increasing_id()), "secret-rows")
    known = F.broadcast(words)
    # Pieces of one case, as in correctHorse_BATTERY, that the dictionary has.
    pieces = F.regexp_extract_all("found", F.lit(r"\p{Lu}?[\p{L}&&[^\p{Lu}]]{2,}|\p{Lu}{3,}"), F.lit(0))
    covered = (rows.select("_llm_row", F.explode(pieces).alias("_llm_piece")).withColumn("word", F.lower("_llm_piece")).join(known, "word")
               .groupBy("_llm_row").agg(F.sum(F.length("_llm_piece")).alias("_llm_covered")))
    last = F.lower(F.regexp_extract("before", r"([\p{L}]+)[^\p{L}]*$", 1))
    following = F.lower(F.regexp_extract("after", r"^[^\p{L}]*([\p{L}]+)", 1))
    rows = rows.join(covered, "_llm_row", "left")
    for side, word in (("before", last), ("after", following)):
        rows = (rows.withColumn("_llm_word", word)
                .join(known.select(F.col("word").alias("_llm_known")), F.col("_llm_word") == F.col("_llm_known"), "left")
                .withColumn(f"f_word_{side}", F.col("_llm_known").isNotNull().cast("double")).drop("_llm_word", "_llm_known"))
    text, n = F.col("found"), F.length("found")
    cols = {"f_length": n.cast("double"), "f_distinct": F.size(F.array_distinct(F.split(text, ""))).cast("double")}
    for a, one in _KINDS.items():
        for b, two in _KINDS.items():
            cols[f"f_{a}_{b}"] = _share(F.regexp_count(text, F.lit(f"(?<={one})(?={two})")), n - 1)
    cols["f_covered"] = _share(F.coalesce("_llm_covered", F.lit(0)), n)
    path = F.coalesce(F.col("path"), F.lit(""))
    cols["f_path_depth"] = F.regexp_count(path, F.lit("/")).cast("double")
    cols["f_path_example"] = path.rlike("(?i)(test|example|sample|mock|fixture|doc)").cast("double")
    cols["f_path_number"] = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(path, "([0-9]{1,6})[^0-9]*$", 1), F.lit("")),
                                                       F.lit("999999")).cast("double"), F.lit(-1.0))
    cols["f_credential"] = F.col("before").rlike(CREDENTIAL).cast("double")
    cols["f_credential_near"] = F.right("before", F.lit(16)).rlike(CREDENTIAL).cast("double")
    cols["f_assigned"] = F.col("before").rlike("[=:>]\\s*[\"'`]?$").cast("double")
    cols["f_quoted"] = F.col("before").rlike("[\"'`]$").cast("double")
    cols["f_example"] = F.concat("before", F.lit(" "), "after").rlike(EXAMPLE).cast("double")
    names = [*cols, "f_word_before", "f_word_after"]
    return rows.withColumns(cols).drop("_llm_row", "_llm_covered"), names


def known_format() -> Column:
    """Label of a finding: true by the formats of issued keys, as the first line of a
    private key, or as a value assigned to a credential name (in quotes, or of digits and others); false for what is surely something
    else (phone, card, date, version, UUID or path forms that nothing assigns); NULL for the rest."""
    key = F.col("found").rlike(KEY_FORMATS) | F.col("before").rlike(r"PRIVATE KEY( BLOCK)?-----\s*$")
    assigned = F.col("before").rlike(f"(?i){NAME}{SIGN}[\"'`]?$")
    # The forms are short; the bound keeps the pattern's groups off very long findings.
    mixed = F.col("found").rlike("[0-9]") & F.col("found").rlike(r"[^0-9\s]")
    assigned_for_sure = assigned & (F.col("before").rlike("[\"'`]$") | mixed)
    decoy = (F.length("found") <= 128) & F.left("found", F.lit(129)).rlike(DECOYS)
    return (F.when(key | (assigned_for_sure & ~decoy & ~F.col("found").rlike(PLACEHOLDER)), F.lit(True))
            .when(decoy & ~assigned, F.lit(False)))


def train(labelled: DataFrame, names: list[str], max_labelled: int = MAX_LABELLED) -> RandomForestClassificationModel | None:
    """Forest of ``labelled`` findings (feature columns and boolean ``label``);
    None where only one kind is there."""
    known = labelled.where("label IS NOT NULL").select(*names, F.col("label").cast("double").alias("label"))
    sample = written(known.orderBy(F.xxhash64(*names, F.lit(SEED)), *names).limit(max_labelled), "secret-labelled")
    if sample.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=names, outputCol="features").transform(sample))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: the id, ``start``, ``length``, ``finding_sha256``,
    ``score`` (the forest's probability) and ``is_secret`` (0.5 or more).

    ``labelled``: findings with the columns of ``candidates`` and a boolean
    ``label``, as of ``secret_labels``; by default the candidates themselves under ``known_format``.
    """
    words = dictionary(docs, text_col)
    found, names = features(candidates(docs, id_col, text_col, path_col), words)
    found = written(found, "secret-candidates")
    known = found.withColumn("label", known_format()) if labelled is None else features(labelled, words)[0]
    model = train(known, names)
    if model is None:
        judged = found.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(found))
        judged = scored.withColumn("score", F.round(F.element_at(vector_to_array("probability"), 2), 6))
    return judged.select(F.col("id").alias(id_col), "start", F.length("found").alias("length"),
                         F.sha2(F.col("found"), 256).alias("finding_sha256"), "score",
                         F.coalesce(F.col("score") >= 0.5, F.lit(True)).alias("is_secret"))
