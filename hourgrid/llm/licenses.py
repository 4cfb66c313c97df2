"""License scans: TF-IDF cosine of headers and licence files to templates, inherited along directories.

Texts are cut into pieces at line breaks and ends of sentences. Every group of up to
``GROUP`` consecutive pieces is compared, as a sparse TF-IDF vector of its words, with the
headers, so a notice is met as a whole however it is wrapped; groups begin and end at
pieces with a telling word of a header. A whole text is compared with the whole licence
files. A cosine of at least ``THRESHOLD`` names the license: by the whole text if that
reaches it, else by the best group.

Document frequencies are those among the templates, and words that no template has weigh
the most. So a file's result depends on the file alone, not on the corpus around it.

Texts without any of the templates' heavy words cannot reach the threshold (the other
words of a template are less than that share of its length), so only texts and groups
with one are compared, each distinct group once.

A file is a license file if it is one as a whole, or its name says so, or telling pieces in
notices, each distinct one once, hold at least ``FILE_SHARE`` of its words. Files without a license of their own
inherit that of the nearest directory above them that has a license file.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.license_texts import FILES, HEADERS
from hourgrid.session import saved

THRESHOLD = 0.75
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)([._-][^/]*)?$"
TERM = "[a-z0-9]+"
#: Where texts are cut into pieces.
CUT = r"\r?\n|\r|(?<=[.!?])[ \t]+"
#: Pieces in a group, at most: the longest header has eight lines of 60 characters.
GROUP = 8
#: A telling word has three letters or more and stands in less than this share of the templates, or is a heavy one.
TELLING = 0.25
#: Keys of at least this share of all rows are joined by broadcast: at most 1 / HOT of them.
HOT = 0.001


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def plain_words(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


class Vectors:
    """TF-IDF vectors of the templates, as unit weights by word; a word that stands n times weighs 1 + ln(n) times its idf.

    Kind 0 are headers, kind 1 whole files.
    """

    def __init__(self, headers: list[tuple[str, str]], files: list[tuple[str, str]], threshold: float = THRESHOLD):
        texts = [(0, *t) for t in headers] + [(1, *t) for t in files]
        sets = [set(plain_words(t)) for _, _, t in texts]
        df = {w: sum(w in s for s in sets) for w in sorted(set().union(*sets))}
        self.idf = {w: math.log((len(sets) + 1) / (n + 1)) + 1 for w, n in df.items()}
        self.rarest = math.log(len(sets) + 1) + 1
        self.rows: list[tuple[int, int, str, str, float]] = []
        self.heavy: tuple[set[str], set[str]] = (set(), set())
        self.telling = {w for s, (kind, _, _) in zip(sets, texts) if kind == 0 for w in s if df[w] < TELLING * len(sets)}
        for n, (kind, name, text) in enumerate(texts):
            words = plain_words(text)
            weight = {w: (1 + math.log(words.count(w))) * self.idf[w] for w in words}
            length = math.sqrt(sum(x * x for x in weight.values()))
            self.rows += [(kind, n, name, w, x / length) for w, x in sorted(weight.items())]
            # long words first: they are the rarer ones in texts
            rest = sorted(weight.items(), key=lambda i: (-len(i[0]), -i[1], i[0]))
            while math.sqrt(sum(x * x for _, x in rest)) >= 0.999 * threshold * length:
                self.heavy[kind].add(rest.pop(0)[0])
            self.telling |= self.heavy[0]
        self.telling = {w for w in self.telling if re.fullmatch("[a-z]{3,}", w)}

    def may_reach(self, text: Column, threshold: float) -> Column:
        """Whether a text shares enough words with a licence file: their squared weights bound the cosine's square."""
        squares: dict[int, dict[str, float]] = {}
        for kind, n, _, w, y in self.rows:
            if kind == 1:
                squares.setdefault(n, {})[w] = y * y
        shared = F.array_intersect(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*[F.lit(w) for w in sorted(set().union(*squares.values()))]))

        def enough(of: dict[str, float]) -> Column:
            found = F.create_map(*[F.lit(x) for w in sorted(of) for x in (w, of[w])])
            return F.aggregate(shared, F.lit(0.0), lambda a, w: a + F.coalesce(F.element_at(found, w), F.lit(0.0))) >= 0.999 * threshold ** 2

        return F.coalesce(*[F.when(enough(of), True) for of in squares.values()], F.lit(False)) if squares else F.lit(False)


def has_word(text: Column, words: set[str]) -> Column:
    """Whether one of the words stands in a text, whole; null for null."""
    return F.lower(text).rlike(r"(?<![a-z0-9])(?:" + "|".join(sorted(words)) + r")(?![a-z0-9])") if words else F.lit(False)


def cosines(units: DataFrame, vectors: Vectors, threshold: float) -> DataFrame:
    """(kind, h1, h2, license, cosine): the best template of each distinct (kind, h1, h2, unit) that reaches the threshold."""
    spark = units.sparkSession
    by = ["kind", "h1", "h2"]
    weights = F.create_map(*[x for w, v in sorted(vectors.idf.items()) for x in (F.lit(w), F.lit(v))])
    terms = units.select(*by, F.explode(words_of(F.col("unit"))).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("tf"))
    terms = terms.withColumn("x", (1 + F.log(F.col("tf"))) * F.coalesce(F.element_at(weights, F.col("word")), F.lit(vectors.rarest)))
    lengths = terms.groupBy(*by).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    posted = spark.createDataFrame(vectors.rows, "kind int, template int, license string, word string, y double")
    dots = terms.join(F.broadcast(posted), ["kind", "word"]).groupBy(*by, "template", "license").agg(  # the templates' words: fixed
        F.sum(F.col("x") * F.col("y")).alias("dot"))
    scored = dots.join(lengths, by).withColumn("cosine", F.round(F.col("dot") / F.col("length"), 9)).filter(F.col("cosine") >= threshold)
    best = F.min_by(F.struct("license", "cosine"), F.struct(-F.col("cosine"), "license"))
    return scored.groupBy(*by).agg(best.alias("b")).select(*by, "b.license", "b.cosine")


def join_left(rows: DataFrame, keyed: DataFrame, on: list[str], total: int) -> DataFrame:
    """A left join with one row a key. Keys of many rows are joined by broadcast, so no task gets all rows of one.

    At most ``1 / HOT`` keys can hold that share of ``total`` rows each, whatever the size of the tables.
    """
    hot = rows.groupBy(*on).count().filter(F.col("count") >= max(2, HOT * total)).select(*on)
    hot = saved(hot.join(keyed, on, "left").withColumn("__hot", F.lit(True)), "license-hot")
    marked = rows.join(F.broadcast(hot), on, "left")
    others = marked.filter("__hot is null").select(*rows.columns).join(keyed, on, "left")
    return others.unionByName(marked.filter("__hot").drop("__hot"))


def scan(files: DataFrame, id_col: str = "doc_id", path: Column | str = "path", text_col: str = "text",
         headers: list[tuple[str, str]] = HEADERS, license_files: list[tuple[str, str]] = FILES,
         threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """(id, path, license, cosine, notice, is_license_file, inherited, inherited_from, effective), a row for each file.

    ``license`` is the file's own, by the whole text (``notice`` is null then) or by its
    best group of pieces ``notice``; ``inherited`` that of the nearest directory with a
    license file (its own directory first), from the file ``inherited_from``;
    ``effective`` the first of the two that there is. Ties of cosine go to the smaller
    name, then notice; of license files in a directory the best cosine counts, then the
    smaller path.

    Null, empty and blank texts have no license of their own but inherit. Null paths stand
    in the root directory, above all others. Rows with the same id, path and text get the
    same result each; null ids are rows like others. Without files there are no rows.
    Columns not named are not read.
    """
    where = F.col(path) if isinstance(path, str) else path
    rows = files.select(F.col(id_col).alias("id"), where.cast("string").alias("path"), F.col(text_col).alias("text"))
    rows = rows.withColumn("uid", F.xxhash64("id", "path", "text"))
    vectors = Vectors(headers, license_files, threshold)

    # texts with a heavy word: their pieces, and the whole text where it may be a licence file
    in_header, in_file = has_word(F.col("text"), vectors.heavy[0]), has_word(F.col("text"), vectors.heavy[1])
    pieces = F.filter(F.split(F.col("text"), CUT), lambda x: x.rlike("[A-Za-z0-9]"))
    slim = saved(rows.select("id", "path", "uid", F.regexp_count(F.lower("text"), F.lit(TERM)).alias("n_words"),
                             F.when(in_header, pieces).alias("pieces"), F.when(in_file, F.col("text")).alias("whole")), "license-files")
    total = slim.count()

    # the groups that begin and end with a telling piece and have a heavy word
    ahead = slim.filter("pieces is not null").select("uid", F.explode(F.transform(
        "pieces", lambda x, i: F.slice("pieces", i + 1, GROUP))).alias("ahead"))
    ahead = ahead.filter(has_word(F.col("ahead")[0], vectors.telling) & has_word(F.array_join("ahead", " "), vectors.heavy[0]))
    groups = ahead.select("uid", "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n")).filter(
        has_word(F.element_at("ahead", F.col("n")), vectors.telling)).select(
        "uid", F.array_join(F.slice("ahead", F.lit(1), F.col("n")), " ").alias("unit"),
        F.transform(F.slice("ahead", F.lit(1), F.col("n")), lambda x: F.struct(
            F.xxhash64(x).alias("piece"), F.when(has_word(x, vectors.telling), F.regexp_count(F.lower(x), F.lit(TERM))).otherwise(
                0).alias("words"))).alias("parts"))
    groups = groups.filter(has_word(F.col("unit"), vectors.heavy[0])).withColumns(_named(0))
    groups = saved(groups, "license-groups")
    wholes = slim.filter("whole is not null").filter(vectors.may_reach(F.col("whole"), threshold)).select(
        "uid", F.col("whole").alias("unit")).withColumns(_named(1))

    by = ["kind", "h1", "h2"]
    units = groups.select(*by, "unit").dropDuplicates(by).unionByName(wholes.select(*by, "unit").dropDuplicates(by))
    named = saved(cosines(units, vectors, threshold), "license-units")

    n_groups = groups.count()
    noted = join_left(groups, named, by, n_groups).filter("license is not null")
    notices = noted.groupBy("uid").agg(F.min_by(
        F.struct("license", "cosine", F.col("unit").alias("notice")), F.struct(-F.col("cosine"), "license", "unit")).alias("o"))
    covered = noted.select("uid", F.explode("parts").alias("part")).distinct().groupBy("uid").agg(
        F.sum("part.words").alias("notice_words"))
    entire = join_left(wholes.select("uid", *by), named, by, total).filter("license is not null").groupBy("uid").agg(
        F.first(F.struct("license", "cosine", F.lit(None).cast("string").alias("notice"))).alias("w"))

    named_file = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    own = F.coalesce("w", "o")
    found = slim.select("id", "path", "uid", "n_words").join(notices, "uid", "left").join(covered, "uid", "left").join(
        entire, "uid", "left").select(
        "id", "path", own["license"].alias("license"), own["cosine"].alias("cosine"), own["notice"].alias("notice"),
        (F.col("w").isNotNull() | (F.col("o").isNotNull() & (named_file | F.coalesce(
            F.col("notice_words") >= file_share * F.col("n_words"), F.lit(False))))).alias("is_license_file"),
        directory(F.col("path")).alias("dir"))
    found = saved(found, "license-found")

    licensed = found.filter("is_license_file").groupBy("dir").agg(F.min_by(
        F.struct("license", "path"), F.struct(-F.col("cosine"), F.coalesce("path", F.lit("")), "license")).alias("of"))
    above = found.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("up"))
    nearest = above.join(licensed.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(
        F.max_by("of", F.length("up")).alias("of"))
    return join_left(found, nearest, ["dir"], total).select(
        "id", "path", "license", "cosine", "notice", "is_license_file", F.col("of.license").alias("inherited"),
        F.col("of.path").alias("inherited_from"), F.coalesce("license", "of.license").alias("effective"))


def _named(kind: int) -> dict[str, Column]:
    """A unit's kind and 128-bit name."""
    return {"kind": F.lit(kind), "h1": F.xxhash64("unit"), "h2": F.xxhash64(F.lit(1), "unit")}


def directory(path: Column) -> Column:
    """All before the last slash; empty for the root."""
    return F.coalesce(F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.lit(""))


def ancestors(folder: Column) -> Column:
    """The folder and all above it, up to the root (empty)."""
    parts = F.split(folder, "/")
    return F.array_distinct(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))
