"""Secret scans: candidate strings, and a random forest that removes false positives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.sources.sinks import stored

# A candidate of its own: sixteen or more characters of the usual secret alphabets in one run.
ALPHABET = r"A-Za-z0-9+/_\-"
RUN = rf"(?<![{ALPHABET}])[{ALPHABET}]{{16,}}+"
# The forest is trained on this many labelled findings at most, drawn by hash.
MAX_LABELLED = 20_000
NEIGHBOURS = 60
SEED = 17

# Words that make a string readable, and words that stand next to secrets.
DICTIONARY = (
    "about access account admin after all and api app apple are article auth background backup base before body "
    "browser build button cache can center change check class client cloud code color column com common config "
    "connect container content control copy count create current data database date debug default delete demo "
    "der description dev die div document domain edit else email en end error event example false field file filter "
    "first folder font for format from function get global group handler header height hello home host html http "
    "https icon image index info input install int item key label language last layout left length level lib license "
    "line link list load local log login main manager map master max menu message method min mode model module more name "
    "net new node not null number object on open option order org page parent parse password path place point port post "
    "primary private process product profile public query read record remove report request reset resource response "
    "result return right role root row run sample save schema search section select server service session set setting "
    "size source space start state static status string style sub system tab table tag target template test text that the "
    "this time title token tool top true type und unit update upload url user utils value version view window with word "
    "work world write www your zone"
).split()
NEAR = "api apikey auth authorization bearer credential credentials key passwd password private pwd secret token".split()
# What stands between a name and the value it is set to.
QUOTE = "[\"'`]"
SET = "(?:={1,3}>?|:=?)"
MARKS = r"[,;&)}\]\"'`]"
SCHEME = "(?i:basic|bearer|digest|token)"
# An unquoted value: all up to a blank, without closing marks, or up to a mark and the next name.
OPEN = rf"(?![=:>\"'`])(?!{SCHEME}\s+\S)(?:[^\s,;&)}}\]\"'`]|{MARKS}++(?=\S)(?![A-Za-z_][\w.\-]*=))++"


def _candidate(blanks: int) -> str:
    """Pattern of candidates, with up to ``blanks`` blanks on a side of what sets a value.

    Besides runs it finds values set to a credential's name, of any length and alphabet,
    quoted or not, and the password of "//user:password@host". Each lookbehind is tried for
    every length it may have, so short ones go first.
    """
    gap = rf"\s{{0,{blanks}}}"
    given = rf"{QUOTE}?{gap}{SET}{gap}"
    named = rf"(?i:{'|'.join(NEAR)}){given}"
    login = rf"(?i:authorization){given}{QUOTE}?{SCHEME}\s{gap}"
    quoted = [rf"(?<={q})(?<=[=:>]{gap}{q})(?<={named}{q})(?:[^{q}\\]|\\.)++(?={q})" for q in "\"'`"]
    bare = rf"(?<=[=:>\s\"'`])(?<=[=:>]{gap}{QUOTE}?)(?<={named}{QUOTE}?){OPEN}"
    url = r"(?<=:)(?<=//[^\s/:@\"']{0,200}:)[^\s/\"']+(?=@)"
    return "|".join([*quoted, bare, rf"(?<=\s)(?<={login}){OPEN}", url, RUN])


CANDIDATE = _candidate(8)
# For lines with more blanks in a row than that, as in aligned columns.
WIDE, CANDIDATE_WIDE = r"\S\s{9}", _candidate(400)
# Cheaper: every text or line with a candidate has one of these.
HINT = rf"{RUN}|(?i:{'|'.join(NEAR)}){QUOTE}?\s*[=:]|//[^\s/:@]*:[^\s/]+@"
PLACES = "demo doc docs example examples fixture fixtures mock sample samples spec test tests".split()

FEATURES = ["length", "digits", "uppers", "lowers", "signs", "hex", "turns", "repeats", "vowels", "known", "place", "near", "given", "quoted"]


def findings(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Candidates of every document: (id, path, line, nth, token, before, after).

    ``token`` is the ``nth`` of a line: a run of sixteen or more characters of the candidate
    alphabet, or any value set to a credential's name (``NEAR``) or standing as the password
    of a connection string, whatever its length and alphabet. ``before`` and
    ``after`` are the neighbouring words: the line's text on either side, up to ``NEIGHBOURS``
    characters. Other candidates stand in it if they read as words or names (no digits, or a
    separator behind them), so the name that a value is set to is there at any length; other
    strings of letters and digits are left out of it, as they are no words. Texts and lines
    without a candidate are not cut.
    """
    def wide_or(cut: Callable[[str], Column]) -> Column:
        return F.when(F.col("text").rlike(WIDE), cut(CANDIDATE_WIDE)).otherwise(cut(CANDIDATE))

    rows = docs.select(F.col(id).alias(id), F.col(path).cast("string").alias("path"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").rlike(HINT))
    rows = rows.select(id, "path", F.posexplode(F.split("text", r"\n")).alias("line", "text"))
    rows = rows.where(F.col("text").rlike(HINT))
    rows = rows.select(
        id,
        "path",
        "line",
        wide_or(lambda pattern: F.split("text", pattern)).alias("between"),
        wide_or(lambda pattern: F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("tokens"),
    )
    named = F.transform(
        "tokens",
        lambda t, k: F.when(~t.rlike("[0-9]") | F.get("between", k + 1).rlike(rf"^{QUOTE}?\s*{SET}"), t).otherwise(""),
    )
    rows = rows.withColumn("named", named)
    # Candidates are apart by one character at least, so no more of them can be in reach.
    reach = F.lit(NEIGHBOURS)

    def found(token: Column, nth: Column) -> Column:
        first = F.greatest(nth - reach, F.lit(0))
        left = F.zip_with(F.slice("between", first + 1, nth - first), F.slice("named", first + 1, nth - first), lambda b, n: F.concat(b, n))
        right = F.zip_with(F.slice("named", nth + 2, reach), F.slice("between", nth + 3, reach), lambda n, b: F.concat(n, F.coalesce(b, F.lit(""))))
        return F.struct(
            nth.alias("nth"),
            token.alias("token"),
            F.right(F.concat(F.array_join(left, ""), F.get("between", nth)), reach).alias("before"),
            F.left(F.concat(F.get("between", nth + 1), F.array_join(right, "")), reach).alias("after"),
        )

    return rows.select(id, "path", "line", F.inline(F.transform("tokens", found)))


def features(found: DataFrame) -> DataFrame:
    """Add the forest's inputs to findings: numbers from the token, its path and its neighbours."""
    token, lowered = F.col("token"), F.lower("token")
    length = F.length("token").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count("token", F.lit(pattern)) / length

    # Words of the dictionary found in the token, the longest at each place.
    words = "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=lambda w: (-len(w), w)))
    near = F.lower(F.concat_ws(" ", "before", "after"))
    columns = {
        "length": length,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "signs": share("[^A-Za-z0-9]"),
        "hex": (token.rlike("^[0-9a-f]+$") | token.rlike("^[0-9A-F]+$")).cast("double"),
        # Places where the kind of character changes, and where a character repeats.
        "turns": F.regexp_count("token", F.lit("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])")) / length,
        "repeats": F.regexp_count("token", F.lit(r"(.)(?=\1)")) / length,
        "vowels": share("[aeiouAEIOU]"),
        "known": 1 - F.length(F.regexp_replace(lowered, words, "")) / length,
        "place": F.coalesce(F.lower("path").rlike(rf"(?<![a-z])(?:{'|'.join(PLACES)})(?![a-z])"), F.lit(False)).cast("double"),
        "near": near.rlike(rf"(?<![a-z])(?:{'|'.join(NEAR)})(?![a-z])").cast("double"),
        "given": F.col("before").rlike(rf"[=:]\s*{QUOTE}?$").cast("double"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
    }
    return found.withColumns({k: v.cast("double") for k, v in columns.items()})


def train(labelled: DataFrame, trees: int = 20, depth: int = 6) -> PipelineModel:
    """Random forest from labelled findings: the columns of ``findings`` and ``label`` (1: a secret)."""
    rows = features(labelled.where(F.col("label").isNotNull()))
    mixed = F.xxhash64(F.lit(SEED), "token", "before")
    rows = rows.orderBy(mixed, "token", "before").limit(MAX_LABELLED).select(*FEATURES, F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featuresCol="inputs", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="inputs"), forest]).fit(stored(rows, "labelled"))


def weak_label() -> Column:
    """Label of a finding where nobody has labelled it.

    A secret is a string of mixed letters and digits, eight at least, that a credential's name, bare or quoted, is set to, or that follows the word "bearer". A string
    of letters or of digits only is none, nor is one without both that no such name stands
    before. Others stay null: a mixed string without a name may be either.
    """
    named = F.lower("before").rlike(rf"(?:{'|'.join(NEAR)}){QUOTE}?\s*{SET}\s*{QUOTE}?$|(?<![a-z])bearer\s+{QUOTE}?$")
    both = F.col("token").rlike("[A-Za-z]") & F.col("token").rlike("[0-9]")
    plain = F.col("token").rlike("^[A-Za-z]+$|^[0-9]+$")
    return F.when(named & both & (F.length("token") >= 8), 1).when(plain | (~named & ~both), 0)


def judged(found: DataFrame, model: PipelineModel, least: float = 0.5) -> DataFrame:
    """Add ``score``, the forest's share of votes for a secret, and ``secret``."""
    rows = model.transform(features(found))
    score = F.get(vector_to_array("probability"), F.lit(1))
    rows = rows.withColumn("score", F.coalesce(score, F.lit(0.0)))
    return rows.select(*found.columns, "score", (F.col("score") >= least).alias("secret"))


def in_training(id: str = "doc_id") -> Column:
    """Documents whose findings may be used for training: three quarters, by the id's checksum."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 != 2, F.lit(False))


def scan(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """Every candidate of every document: (doc_id, line, nth, token, label, score, secret).

    The forest looks at length, kinds of character and their transitions, coverage by a
    dictionary, the path (``source``) and the neighbouring words. ``labelled`` holds labelled
    findings to train on; without it the findings of three quarters of the documents are
    labelled by ``weak_label``, which is also given as ``label``. Labels of one kind only
    give a forest that always votes for it.

    Documents without a candidate, null and empty texts give no rows; a candidate gives one
    row, repeated rows repeat theirs. A null source is no test path, a null id stays null
    and is not trained on. Without a labelled finding no forest can be grown: every score is
    null and every candidate stays a secret. Columns other than doc_id, text and source are not read.
    """
    found = stored(findings(docs).withColumn("label", weak_label()), "findings")
    known = found.where(in_training()) if labelled is None else labelled
    known = known.where(F.col("label").isNotNull())
    if known.isEmpty():
        rows = found.select("*", F.lit(None).cast("double").alias("score"), F.lit(True).alias("secret"))
    else:
        rows = judged(found, train(known), least)
    return rows.select("doc_id", "line", "nth", "token", "label", "score", "secret")
