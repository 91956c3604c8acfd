"""Secret scans: candidates by form and place, and a random forest that removes the false ones.

Method: the words of a text are cut at quotes, brackets and signs of assignment. Parts with a
digit, with mixed letter case or of unusual length are candidates, and whatever their form those
that are assigned to or follow a word like "password" or stand before the @ of an address with
credentials. How long a secret has to be is for the forest to say. Labelled findings train a
random forest on length, character transitions, dictionary coverage, path and neighbouring words.
The forest's trees become SQL expressions, so the whole scan consists of Spark's own functions
and it has no joins: the dictionary, of a bounded size, goes along as a table.
"""

import math
import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut, words_of
from tallyfold.llm.quality import let

#: The dictionary has the words that make up at least one in so many; so there are at most so many.
DICTIONARY = 50_000
#: Labelled findings, of each label, that the forest is trained on.
FITTED_FINDINGS = 4000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
MASK = "[SECRET]"

KEYWORD = "(?i)(pass|pwd|secret|token|api|key|auth|cred)"
EXAMPLE_PATH = "(?i)(test|example|sample|fixture|mock|demo)"
#: Forms that are labelled as secrets wherever they stand.
REAL_FORMS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36}$|^sk_live_[0-9A-Za-z]{24,}$|^AIza[0-9A-Za-z_-]{35}$|^xox[abprs]-[0-9A-Za-z-]{10,}$"
#: Forms that are labelled as none unless what is around them says otherwise; what fits neither is not trained on.
PLACEHOLDERS = r"(?i)x{6,}|example|changeme|placeholder|^\*+$|^(true|false|null|none|yes|no)$"
FALSE_FORMS = r"^//|^[0-9.,()+/-]+$|^[^0-9]+$"
ADDRESS = r"^[^@:/=]+@[^@:/=]+\.\p{L}{2,}"

#: What separates the parts of a word, and what is taken off the end of a part.
SEPARATORS = "\"'`=:&,;?@|()\\[\\]{}<>"
PART = f"([{SEPARATORS}]*)([^{SEPARATORS}]+)"
EDGE = "[.!#*$%]+$"
#: Words of which no part is a candidate by its form: they have none of these.
SUSPECT = "[0-9]|[a-z][A-Z]|[=:@]|.{20}"
#: Places of the dictionary's table; a place has a few words.
PLACES = 1 << 14

FEATURES = ["size", "digits", "capitals", "switches", "vowels", "hexadecimal", "transitions", "coverage", "example_path", "keyword", "assigned", "credential", "text_before", "text_after"]


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, row_key, place, part, word, candidate, name, sign, credential, before, before_2, after, path) of every candidate.

    `row_key` is a hash of the id and the text, so it tells documents without an id apart.
    `place` is the number of the word in the text, from 0, `part` that of the part in the word.
    `name` is the part before within the word if `sign`, what separates both, assigns. A
    `credential` follows a colon and comes before an @ in an address with a scheme.
    """

    def found(w):
        worth = lambda i: F.get(w, i).rlike(SUSPECT) | F.coalesce(F.get(w, i - 1).rlike(KEYWORD), F.lit(False)) | (F.coalesce(F.get(w, i - 1).rlike("^[=:]+$"), F.lit(False)) & F.coalesce(F.get(w, i - 2).rlike(KEYWORD), F.lit(False)))
        places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), worth)
        own = lambda i: F.struct(i.alias("place"), F.get(w, i).alias("word"), F.get(w, i - 1).alias("before"), F.get(w, i - 2).alias("before_2"), F.get(w, i + 1).alias("after"))
        return F.when(F.size(w) > 0, F.transform(places, own))

    where = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    key = F.xxhash64("doc_id", "text").alias("row_key")
    rows = docs.select("doc_id", key, where.alias("path"), F.explode(let(words_of(F.col("text")), found)).alias("c")).select("doc_id", "row_key", "path", "c.*")
    parts, signs = (F.regexp_extract_all("word", F.lit(PART), F.lit(group)) for group in (2, 1))
    cut_up = rows.withColumns({"parts": parts, "signs": signs}).select("*", F.posexplode("parts").alias("part", "whole"))
    sign = F.get("signs", F.col("part"))
    named = cut_up.withColumns(
        {
            "candidate": F.regexp_replace("whole", EDGE, ""),
            "sign": sign,
            "name": F.when((F.col("part") > 0) & sign.rlike("[=:]"), F.get("parts", F.col("part") - 1)),
            "credential": F.col("word").contains("://") & sign.startswith(":") & F.coalesce(F.get("signs", F.col("part") + 1).startswith("@"), F.lit(False)),
        }
    )
    texts = {c: F.coalesce(c, F.lit("")) for c in ("sign", "name", "before", "before_2", "after", "path")}
    by_form = F.col("candidate").rlike("[0-9]|[a-z][A-Z]|.{20}")
    kept = named.withColumns(texts).where((F.col("candidate") != "") & (by_form | F.col("credential") | (_by_keyword() & _is_assigned()) | F.col("before").rlike(KEYWORD)))
    return kept.select("doc_id", "row_key", "place", "part", "word", "candidate", "name", "sign", "credential", "before", "before_2", "after", "path")


def _by_keyword() -> Column:
    """A word like "password" names the candidate or stands before it; one before counts for the first part only."""
    near = F.when(F.col("part") == 0, F.concat_ws(" ", "before", F.when(F.col("before").rlike("^[^\\p{L}]*$"), F.col("before_2"))))
    return F.concat_ws(" ", "name", near).rlike(KEYWORD)


def _is_assigned() -> Column:
    return (F.col("name") != "") | ((F.col("part") == 0) & (F.col("before").rlike("[=:][\"']?$") | F.col("sign").rlike("[=:]")))


def dictionary(docs: DataFrame, share: int = DICTIONARY) -> DataFrame:
    """(entry, n): the words of letters that are at least one in `share` of all documents' words.

    The share bounds their number, so no task has to sort the words of all others.
    """
    words = docs.select(F.explode(F.transform(words_of(F.col("text")), F.lower)).alias("entry"))
    counted = words.groupBy("entry").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return cut(counted.where((F.col("n") * share >= total) & F.col("entry").rlike("^\\p{L}{2,}$")))


def _transition_costs(known: DataFrame) -> list[float]:
    """For each pair of a-z (26: anything else), how unlikely it is in the dictionary's words, in bits."""
    pairs = known.select("n", F.explode(F.expr("transform(sequence(1, length(entry) - 1), i -> substr(entry, i, 2))")).alias("pair"))
    counts = {r.pair: r.n for r in pairs.where(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    letters = [chr(97 + k) for k in range(26)]
    first = {a: sum(counts.get(a + b, 0) for b in letters) for a in letters}
    costs = [-math.log2((counts.get(a + b, 0) + 1) / (first[a] + 27)) for a in letters for b in letters]
    table = []
    for k in range(26):
        table += [*costs[26 * k : 26 * k + 26], 6.0]
    return table + [6.0] * 27


def _lookup(known: DataFrame):
    """A test whether words are in the dictionary, which becomes one literal that Spark folds.

    A word is looked for at its place in a table, among the few others there, so a text may
    look up as many as it has.
    """
    place = lambda w: F.pmod(F.xxhash64(w), F.lit(PLACES)).cast("int")
    listed = known.groupBy(place(F.col("entry")).alias("place")).agg(F.concat_ws(" ", F.collect_list("entry")).alias("entries"))
    table = [""] * PLACES
    for r in listed.collect():
        table[r.place] = f" {r.entries} "
    entries = F.split(F.lit(",".join(table)), ",")
    return lambda w: F.get(entries, place(w)).contains(F.concat(F.lit(" "), w, F.lit(" ")))


def _with_features(rows: DataFrame, known: DataFrame, costs: list[float]) -> DataFrame:
    c, size = F.col("candidate"), F.length("candidate")
    share = lambda pattern: 1 - F.length(F.regexp_replace(c, pattern, "")) / size
    collapsed = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
    table = F.split(F.lit(",".join(f"{x:.3f}" for x in costs)), ",").cast("array<double>")
    letter = "CASE WHEN substr(lower(candidate), {i}, 1) BETWEEN 'a' AND 'z' THEN ascii(substr(lower(candidate), {i}, 1)) - 97 ELSE 26 END"
    places = F.expr(f"transform(sequence(1, length(candidate) - 1), i -> ({letter.format(i='i')}) * 27 + ({letter.format(i='i + 1')}))")
    mean = F.when(size > 1, F.aggregate(places, F.lit(0.0), lambda a, k: a + F.get(table, k)) / (size - 1)).otherwise(0.0)
    strip = lambda name: F.lower(F.regexp_replace(name, "[^\\p{L}]+", ""))
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("\\p{L}{3,}"), F.lit(0))
    is_known = _lookup(known)
    lengths = F.transform(F.concat(F.array(strip("before"), strip("after")), runs), lambda w: F.when(is_known(w), F.length(w)).otherwise(0))
    # Behind a generator, past which no filter moves: the words are looked up once.
    looked_up = rows.select("*", F.explode(F.array(lengths)).alias("known"))
    covered = F.aggregate(F.slice("known", 3, F.size("known")), F.lit(0), lambda a, n: a + n)
    numbers = {
        "size": size,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "switches": F.length(collapsed) / size,
        "vowels": share("(?i)[aeiouàáâäèéêëìíîïòóôöùúûü]"),
        "hexadecimal": c.rlike("^[0-9a-fA-F]+$"),
        "transitions": mean,
        "coverage": covered / size,
        "example_path": F.col("path").rlike(EXAMPLE_PATH),
        "keyword": _by_keyword(),
        "assigned": _is_assigned(),
        "credential": F.col("credential"),
        "text_before": F.get("known", F.lit(0)) > 0,
        "text_after": F.get("known", F.lit(1)) > 0,
    }
    return looked_up.withColumns({f"f_{k}": v.cast("double") for k, v in numbers.items()}).drop("known")


def label_by_form(findings: DataFrame) -> DataFrame:
    """The findings whose form or place tells what they are, with `label`: 1 a secret, 0 none.

    Asked in this order: known formats are secrets; placeholders are none; credentials of an
    address, and what is assigned to a name that says so and is no dictionary word, are secrets;
    mail addresses, parts of web addresses, numbers, dates and words without a digit are none.
    Reviewed findings with such a column can be given to `fit` instead.
    """
    c = F.col("candidate")
    told = (F.col("f_credential") == 1) | ((F.col("f_keyword") == 1) & (F.col("f_assigned") == 1) & (F.col("f_coverage") < 1) & ~c.rlike("^//"))
    none = c.rlike(FALSE_FORMS) | F.col("word").rlike(ADDRESS)
    label = F.when(c.rlike(REAL_FORMS), 1).when(c.rlike(PLACEHOLDERS), 0).when(told, 1).when(none, 0)
    return findings.withColumn("label", label).where("label IS NOT NULL")


def _tree_sql(lines: list[str]) -> str:
    """A tree in the text form that Spark prints, as SQL."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return line.removeprefix("Predict:").strip()
    split = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
    low = _tree_sql(lines)
    lines.pop(0)  # its Else
    high = _tree_sql(lines)
    return f"CASE WHEN f_{FEATURES[int(split[1])]} <= {float(split[2])!r}D THEN {low} ELSE {high} END"


def forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Column:
    """The share of the trees that vote for a secret, as a column; trained on `f_...` and `label`.

    With one label only, that label for all; without labelled rows, 0.
    """
    kinds = {r.label for r in labelled.select("label").distinct().collect()}
    if len(kinds) < 2:
        return F.lit(float(max(kinds, default=0)))
    rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(labelled)
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, subsamplingRate=0.8, featureSubsetStrategy="sqrt")
    model = learner.fit(rows.select("features", F.col("label").cast("double")))
    votes = [_tree_sql(t.toDebugString.strip().split("\n")[1:]) for t in model.trees]
    return F.expr("(" + " + ".join(f"({v})" for v in votes) + f") / {len(votes)}")


def scan(docs: DataFrame, labeller=label_by_form, path: str = "source", rows: int = FITTED_FINDINGS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row_key, place, part, candidate, name, score, is_secret) of every candidate of every document.

    `labeller` gives findings a `label`; of each label the `rows` findings with the least hash
    train the forest, however many there are. A null text has no candidates; a null doc_id
    stays null; a null path, or none, counts as empty. Whole texts are read, repeated rows give
    repeated findings, and an empty table none. Other columns are not read.
    """
    known = dictionary(docs)
    findings = _with_features(candidates(docs, path), known, _transition_costs(known))
    labelled = labeller(findings)
    picked = None
    for value in (0, 1):
        own = labelled.where(F.col("label") == value).orderBy(F.xxhash64("doc_id", "place", "part", "candidate"), "candidate").limit(rows)
        picked = own if picked is None else picked.unionAll(own)
    votes = forest(cut(picked.select("label", *(f"f_{k}" for k in FEATURES))))
    scored = findings.withColumn("score", votes.cast("double"))
    return scored.select("doc_id", "row_key", "place", "part", "candidate", "name", "score", (F.col("score") >= threshold).alias("is_secret"))


def masked(text: Column, secrets: Column) -> Column:
    """The text with each secret replaced where it stands between characters that are no letters or digits."""
    quoted = lambda s: F.concat(F.lit("(?<![\\p{L}\\p{N}])\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E(?![\\p{L}\\p{N}])"))
    longest_first = F.array_sort(secrets, lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(longest_first, text, lambda t, s: F.regexp_replace(t, quoted(s), F.lit(MASK)))


def redact(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """The documents with all their columns, each secret of a document replaced in its text.

    Documents without secrets stay as they are. A document's findings are those of its `row_key`.
    Columns may have any names.
    """
    secrets = findings.where("is_secret").groupBy("row_key").agg(F.collect_set("candidate").alias("secrets"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.xxhash64("doc_id", "text").alias("row_key"))
    text = F.when(F.col("secrets").isNull(), F.col("doc.text")).otherwise(masked(F.col("doc.text"), F.col("secrets")))
    columns = [text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns]
    return rows.join(secrets, "row_key", "left").select(*columns)
