"""Labelled findings for the secret scan: made secrets and made decoys in places of the corpus.

The labels come from how a value was made, not from a rule over its looks: a secret is random
text of a stated alphabet behind the words that introduce it, a decoy is what people write that looks
alike -- numbers, hashes, slugs, paths, identifiers, placeholders.  The surroundings are bounded
samples of the corpus's own prose, so that neighbouring words and the dictionary mean
there what they mean for real findings.  ``FORMS`` marks the forms that tests hold out.

DataFrame functions only; everything depends on hashes of the documents, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import written

PLACES = 2000           # documents whose prose surrounds the made values, at most
EVERY = 12              # each place shows about every so many-th form

# Fixed values: (name, is it a secret, held out by tests, text in front, value, text behind).  In a value, each of
# x X n b w stands for a random sign or word -- x: hex digit, X: capital or digit, n: digit, b: base-64 sign, w: word --
# as often as the number behind it says; the rest is itself.
FORMS = [
    ("password base64", True, False, 'db_password = "', "b24", '"\n'),
    ("token hex", True, False, 'token = "', "x40", '"\n'),
    ("api key hex", True, False, "api_key: ", "x32", "\n"),
    ("secret mixed", True, False, "SECRET=", "b16", "\n"),
    ("short password", True, False, 'password: "', "w1n3!", '" '),
    ("access key id", True, False, "key AKIA-like: ", "AKIAX16", " "),
    ("personal token", True, False, "use ", "ghp_b36", " here"),
    ("bearer", True, False, "Authorization: Bearer ", "b43", "\n"),
    ("private key line", True, False, "-----BEGIN RSA PRIVATE KEY-----\n", "b64", "\n"),
    ("bare random", True, False, "", "b32", " "),
    ("client secret", True, True, "client_secret => '", "b30", "' "),
    ("chat token", True, True, "", "xoxb-n12-b24", " "),
    ("account key", True, True, "AccountKey=", "b86", ";"),
    ("passphrase hex", True, True, "passphrase ", "x24", " "),
    ("signing key", True, True, "signing-key: ", "b44", "\n"),
    ("number", False, False, "number ", "n16", " "),
    ("phone", False, False, "call ", "+n2-n3-n4-n4", " "),
    ("card", False, False, "card ", "n4-n4-n4-n4", " "),
    ("time", False, False, "at ", "20n2-0n1-1n1T0n1-n2", " "),
    ("uuid", False, False, "id ", "x8-x4-x4-x4-x12", " "),
    ("commit", False, False, "commit ", "x40", "\n"),
    ("checksum", False, False, "sha256:", "x64", " "),
    ("path", False, False, "see ", "docs/20n2/w1-n1/page_n2", " "),
    ("slug", False, False, "", "w1-w1-w1-20n2", " "),
    ("release", False, False, "version ", "release-20n2-n2-n1", " "),
    ("identifier", False, False, "call ", "w1_w1_w1n1", "("),
    ("placeholder", False, False, 'password = "', "example-password-n3", '"'),
    ("image data", False, False, "data:image/png;base64,", "iVBORw0KGgoAAAANSUhEUgAAn4AAAn4CAYAAAB", " "),
    ("order id", False, True, "order ", "ORD-20n2-n6", " "),
    ("hardware address", False, True, "device ", "n2-x2-x2-n2-x2-x2", " "),
    ("isbn", False, True, "", "978-n1-n3-n5-n1", ". "),
    ("file hash", False, True, "bundle ", "w1-x8", ".js"),
]
_WORDS = ["river", "house", "garden", "market", "winter", "report", "letter", "bridge", "yellow", "number", "summer", "window"]


def _random(kind: str, n: int, salt: str) -> Column:
    """``n`` signs (or a word) that depend on the place and the salt."""
    seed = F.col("h").cast("string")

    def block(k: int) -> Column:
        return F.sha2(F.concat(seed, F.lit(f"/{salt}/{k}")), 256)

    if kind == "w":
        return F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(len(_WORDS))) + 1).cast("int"))
    text = F.concat(*[block(k) for k in range(-(-n // 40))])
    if kind == "n":
        text = F.translate(text, "abcdef", "271828")
    elif kind == "X":
        text = F.upper(F.translate(F.translate(F.base64(F.unhex(text)), "+/", "77"), "=", ""))
    elif kind == "b":
        text = F.translate(F.regexp_replace(F.base64(F.unhex(text)), r"\s", ""), "=", "")
    return F.substring(text, 1, n)


def _value(pattern: str, salt: str) -> Column:
    import re

    parts = []
    for k, m in enumerate(re.finditer(r"([xXnbw])(\d+)|([^xXnbw]+|[xXnbw])", pattern)):
        parts.append(_random(m[1], int(m[2]), f"{salt}/{k}") if m[1] else F.lit(m[3]))
    return F.concat(*parts)


def labelled_findings(docs: DataFrame, text_col: str, path_col: str, held_out: bool | None = False,
                      places: int = PLACES, every: int = EVERY) -> DataFrame:
    """(id, path, start, before, found, after, label, form): made values of the forms that are
    held out or not, or (None) of all, in ``places`` documents.  Empty where no document has 200 characters."""
    text = F.col(text_col)
    at = F.pmod(F.xxhash64("h", F.lit("place")), F.length("text") - 100).cast("int") + 60
    # Cut at a blank, so that words stay whole.
    before = F.regexp_replace(F.substring(F.col("text"), at - F.lit(55), F.lit(48)), r"[^\s]*\z", "")
    after = F.regexp_replace(F.substring(F.col("text"), at, F.lit(24)), r"^[^\s]*\s?", "")
    pool = (docs.where(F.length(text) >= 200).select(text.alias("text"), F.col(path_col).cast("string").alias("path"), F.xxhash64(text).alias("h"))
            .select("path", "h", before.alias("b"), after.alias("a")).orderBy("h", "path").limit(places))
    made = [F.when(F.pmod(F.xxhash64("h", F.lit(name)), F.lit(every)) == 0, F.struct(
        F.right(F.concat("b", F.lit(lead)), F.lit(48)).alias("before"), _value(value, name).alias("found"),
        F.left(F.concat(F.lit(tail), F.col("a")), F.lit(24)).alias("after"), F.lit(secret).alias("label"), F.lit(name).alias("form")))
        for name, secret, out, lead, value, tail in FORMS if held_out is None or out == held_out]
    rows = written(pool, "secret-places").withColumn("f", F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())))
    return written(rows.select(F.lit(None).cast("long").alias("id"), "path", F.lit(1).cast("long").alias("start"), "f.*"), "secret-made")
