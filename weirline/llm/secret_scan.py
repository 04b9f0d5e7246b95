"""Secret scans: candidate strings, judged by a random forest; DataFrame functions and Spark ML only.

Candidates are long runs of key characters, and whole values behind an assignment, `Bearer` or a user's name in a URL, of any
characters and from MIN_ASSIGNED characters on. Features: length, transitions between kinds of characters,
how much of it a dictionary covers, marks of a path, and the neighbouring words. The forest is
fitted on labelled findings and removes the false positives. The labelled lines are in secret_labels.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secret_labels

#: Characters of keys and paths; a candidate has at least MIN_LENGTH of them in a row, and = as padding at its end only.
MIN_LENGTH = 16
RUN = r"[A-Za-z0-9+/_.\-]{16,}(?:={1,6}(?![A-Za-z0-9+/=_.\-]))?"

#: Words of the dictionary: frequent in English, German, French and Spanish, or in code and paths.
DICTIONARY = (
    "the and ing tion that was for with from this have not you are which what when where would could there their "
    "der die und das ein ich nicht mit auf von den sch ung keit heit lich "
    "les des est une que pour dans pas sur avec eau eux ment aux elle "
    "los las una por con para como mente ado ando ente cion est "
    "all any can did each form had how its just know like make more most new now only other over see some such take than then them these "
    "time two use very want was way well will work year your read write load store open close begin end first last next previous "
    "access token password secret key private public default change insert request response session project application service "
    "authentication configuration environment resource template property provider document reference article version release branch "
    "test example sample user name file path index config main home local share data value class "
    "http https www com org net html json src lib bin usr var opt etc module import license version "
    "summer winter orange welcome football sunshine master shadow string null none true false undefined required "
    "to it is of or on an in at as be by he we me my so up us go no do if"
)
NEAR = r"(?i)(secret|token|passw|passphrase|\b_?pass\b|_pass\b|\bpw\b|\bkey\W*$|pwd|api.?key|apikey|access|auth|credential|private|bearer)"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word, candidate, before, after): each run of key characters, with its word's number in the text and what stands
    before and after it. Before a word's first run that is three words and the word up to there; before
    another, the two runs ahead of it and what lies between."""
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\n\x0B\f\r]+")
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("words"))
    # only a word of MIN_LENGTH bytes or more is put to the pattern
    found = F.expr(
        f"""
        filter(transform(words, (w, i) -> named_struct('word', i, 'raw', w)),
               x -> octet_length(x.raw) >= {MIN_LENGTH} and x.raw rlike '{RUN}')
        """
    )
    near = F.expr(
        """
        transform(found, x -> named_struct('word', x.word, 'raw', x.raw,
          'before', concat_ws(' ', get(words, x.word - 3), get(words, x.word - 2), get(words, x.word - 1)),
          'after', coalesce(get(words, x.word + 1), '')))
        """
    )
    rows = whole.withColumn("found", found).select("doc_id", F.explode(near).alias("x"))
    runs, gaps = F.regexp_extract_all("x.raw", F.lit(RUN), F.lit(0)), F.split("x.raw", RUN, -1)
    each = rows.withColumns({"runs": runs, "gaps": gaps}).select("doc_id", "x", F.explode(F.expr(
        """
        transform(runs, (r, i) -> named_struct('candidate', r,
          'before', if(i = 0, concat_ws(' ', x.before, gaps[0]),
            concat(coalesce(get(runs, i - 2), ''), gaps[i - 1], runs[i - 1], gaps[i])),
          'after', concat(gaps[i + 1], coalesce(get(runs, i + 1), x.after))))
        """
    )).alias("r"))
    return each.select("doc_id", F.col("x.word").alias("word"), "r.candidate", "r.before", "r.after")


#: A value behind a sign of assignment has at least so many characters.
MIN_ASSIGNED = 6
#: A name and = or : before a value in one word, a value in quotes behind them, one behind a URL's user, one of a URL's parameters.
NAME = r"[A-Za-z_][\w.\-]*[\"'\]]*"
SIGN = r"(?:=>|:=|[:=])"
WHOLE = rf"^[\"'(\[{{<,;$-]*{NAME}{SIGN}(?!//|[\"'`])(.{{{MIN_ASSIGNED},}})$"
QUOTED = rf"{NAME}{SIGN}[\"'`]([^\"'`]{{{MIN_ASSIGNED},}})(?:[\"'`]|$)"
USER = rf"://[^/:@]*:(.{{{MIN_ASSIGNED},}})@[^@]*$"
PARAMETER = rf"[?&;]{NAME}=([^&;#]{{{MIN_ASSIGNED},}})"
#: What a word that is a value holds: what its first quotes do, or all of it.
LED = rf"^(?:[\"'`]([^\"'`]{{{MIN_ASSIGNED},}})[\"'`].*|(.{{{MIN_ASSIGNED},}}))$"
#: A word that says that the next one is a value.
LEADS = r"(?:[:=][\"'`]?|^(?:Bearer|Basic)|^=>)$"
TRIM = "\"'`,;()[]{}<>"


def assigned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word, candidate, before, after) as candidates(): each value behind an assignment, whole, outer quotes and brackets taken off.

    In a word with a URL, values are its user's and its parameters'; in another, all behind the first = or :, and each value in quotes.
    A word behind one that ends in = or :, or is Bearer or Basic, is a value. A value that is a run of candidates() is left to it.
    """
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\n\x0B\f\r]+")
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("words"))
    text = lambda p: "'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'"
    found = F.expr(
        f"""
        filter(transform(words, (w, i) -> named_struct('word', i, 'raw', w, 'led', coalesce(get(words, i - 1) rlike {text(LEADS)}, false))),
               x -> octet_length(x.raw) >= {MIN_ASSIGNED} and (x.led or x.raw rlike '[:=]'))
        """
    )
    values = F.expr(
        f"""
        transform(found, x -> named_struct('word', x.word, 'raw', x.raw, 'values', array_distinct(filter(transform(concat(
            if(x.led, array(concat(regexp_extract(x.raw, {text(LED)}, 1), regexp_extract(x.raw, {text(LED)}, 2))), array()),
            if(x.raw rlike '://', concat(regexp_extract_all(x.raw, {text(USER)}, 1), regexp_extract_all(x.raw, {text(PARAMETER)}, 1)),
               concat(regexp_extract_all(x.raw, {text(WHOLE)}, 1), regexp_extract_all(x.raw, {text(QUOTED)}, 1)))),
            v -> trim(BOTH {text(TRIM)} FROM v)), v -> char_length(v) >= {MIN_ASSIGNED} and not v rlike '^(?:{RUN})$')),
          'before', concat_ws(' ', get(words, x.word - 3), get(words, x.word - 2), get(words, x.word - 1)),
          'after', coalesce(get(words, x.word + 1), '')))
        """
    )
    rows = whole.withColumn("found", found).select("doc_id", F.explode(F.filter(values, lambda x: F.size(x["values"]) > 0)).alias("x"))
    each = rows.select("doc_id", "x", F.explode("x.values").alias("candidate"))
    return each.select(
        "doc_id", F.col("x.word").alias("word"), "candidate",
        F.concat_ws(" ", F.col("x.before"), F.expr("substring(x.raw, 1, greatest(locate(candidate, x.raw) - 1, 0))")).alias("before"),
        F.concat(F.expr("substring(x.raw, locate(candidate, x.raw) + char_length(candidate))"), F.lit(" "), F.col("x.after")).alias("after"),
    )


FEATURES = [
    "length", "digits", "upper", "to_digit", "to_letter", "to_lower", "to_upper", "hex", "covered", "vowels", "slashes",
    "dots", "dashes", "padding", "prefix", "said", "assigned", "quoted", "dated", "signs", "kinds", "call",
]


def with_features(rows: DataFrame) -> DataFrame:
    """The features of (candidate, before, after); shares are of the candidate's length."""
    c = F.col("candidate")
    n = F.greatest(F.char_length(c), F.lit(1)).cast("double")

    def share(pattern):
        return F.regexp_count(c, F.lit(pattern)) / n

    words = sorted(set(DICTIONARY.split()), key=lambda w: (-len(w), w))
    rest = F.char_length(F.regexp_replace(F.lower(c), "|".join(words), ""))
    return rows.withColumns(
        {
            "length": n,
            "digits": share("[0-9]"),
            "upper": share("[A-Z]"),
            "to_digit": share("[A-Za-z](?=[0-9])"),
            "to_letter": share("[0-9](?=[A-Za-z])"),
            "to_lower": share("[A-Z](?=[a-z])"),
            "to_upper": share("[a-z](?=[A-Z])"),
            "hex": share("[0-9a-fA-F]"),
            "covered": 1 - rest / n,
            "vowels": share("[aeiouAEIOU]"),
            "slashes": share("/"),
            "dots": share("[.]"),
            "dashes": share("[-_]"),
            "padding": c.rlike("=$").cast("double"),
            "prefix": c.rlike("^(AKIA|ASIA|gh[opsu]_|sk-|sk_live|xox[abp]-|AIza|eyJ|glpat-)").cast("double"),
            "said": F.col("before").rlike(NEAR).cast("double"),
            "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
            "quoted": F.col("before").rlike("[\"'`]$").cast("double"),
            "signs": share(r"[^A-Za-z0-9+/_.\-]"),
            "kinds": sum((c.rlike(p).cast("double") for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]")), F.lit(0.0)),
            "call": c.rlike(r"[\[({<]|^[*x.]+$|://").cast("double"),
            "dated": F.col("before").rlike(r"(?i)(commit|sha\d*|checksum|digest|hash|revision|uuid|etag|md5)\W*$").cast("double"),
        }
    )


def labelled_findings(spark: SparkSession, lines: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Labelled findings (candidate, before, after, label): every candidate of the labelled lines, which tell their secrets.
    A candidate that holds a secret, or is the longest run of one, counts as it."""
    rows = [(k, text, secrets) for k, (text, secrets) in enumerate(secret_labels.lines() if lines is None else lines)]
    table = spark.createDataFrame(rows, "doc_id long, text string, secrets array<string>")
    found = candidates(table).unionByName(assigned(table)).join(table.select(F.col("doc_id").alias("_id"), "secrets"), F.col("doc_id") == F.col("_id"))
    whole = F.exists("secrets", lambda s: F.contains(s, F.col("candidate")) | F.contains(F.col("candidate"), s))
    return found.select("candidate", "before", "after", whole.cast("double").alias("label"))


def fit(labelled: DataFrame, most_labelled: int = 20_000, trees: int = 24, depth: int = 8):
    """The forest over at most ``most_labelled`` labelled findings, of more the first by a hash; a fixed seed."""
    if len(labelled.select("label").take(most_labelled + 1)) > most_labelled:  # the same ones each time
        labelled = labelled.orderBy(F.xxhash64("candidate", "before"), "candidate", "before", "after").limit(most_labelled)
    rows = with_features(labelled).select(*FEATURES, F.col("label").cast("double").alias("label"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).coalesce(1)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, subsamplingRate=0.8)
    # a copy has no training summary, which would bring the session along to the tasks
    return forest.fit(vectors.select("features", "label")).copy()


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, word, candidate, probability) of each finding that the forest leaves.

    Null and empty texts have none; a word's number counts from 0 over runs between ASCII white space
    (an empty first word where the text begins with white space). Rows that repeat an id are scanned
    one by one; other columns are not read. An empty table gives no rows.
    """
    model = fit(labelled_findings(docs.sparkSession) if labelled is None else labelled)
    rows = with_features(candidates(docs, id_col, text_col).unionByName(assigned(docs, id_col, text_col)))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)
    judged = model.transform(vectors.select("doc_id", "word", "candidate", "features"))
    return judged.select(
        "doc_id", "word", "candidate", F.round(vector_to_array("probability")[1], 6).alias("probability")
    ).filter(F.col("probability") >= threshold)
