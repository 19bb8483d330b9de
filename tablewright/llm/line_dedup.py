"""Line dedup by a log-template tree, DataFrame functions only.

A line is parsed like a log message: runs of digits are masked, and the number of tokens and the first tokens
lead to a leaf of the tree. In a leaf, a token is constant at its position if two documents or more have it there,
else it is a variable field. Lines with the same constants in the same places are one template, if most of its
tokens are constant. A template met in several documents recurs: the first document keeps its lines, all others
lose theirs.

That is the query's rule, as its SQL has it. ``by_similarity`` decides by likeness instead: lines of a leaf that agree
in most tokens are variants. They meet by equal segments, one of which two such lines share at least, and are compared
with the first lines of the segment; in leaves of any size they also meet by templates that leave out one token or the
rarest ones. Lines that have met no earlier variant so far are compared with all lines of their segments, crowded ones
being parted into finer segments till few lines are left. All this goes by distinct lines, so copies of a line, or of a
field's value, change nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import bitmap, cut, maybe_in

#: Shorter lines are no templates; tokens that lead to a leaf; least share of constant tokens.
MIN_TOKENS, DEPTH, SIMILARITY = 5, 3, 0.8
#: What a single space replaces: runs of white space but line ends, and other white space than a space.
SPACES = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
LINE = ("line1", "line2")
#: A token of digits and marks, after masking.
FIGURE = r"(?<![^ ])(?=[^ ]*0)[^\p{L} ]++(?![^ ])"

#: Lines of a segment that all others of it are compared with first; open lines of a segment that are few enough to be
#: compared with each line of it. Neither changes a result.
HUBS, CROWD = 8, 32


def _split(docs: DataFrame, id_col: str, text_col: str, places: DataFrame | None, *forms) -> DataFrame:
    """(doc, hash, pos, each form of the line): the text's lines, put into one form or several.

    Forms are made of whole texts before these are split. With a bitmap of ``places``, hashes of (hash, pos), texts are
    split first and just the lines at these places are put into form.
    """
    text = F.col(f"`{text_col}`")
    named = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text")).where("doc is not null")
    if places is not None:
        lines = named.select("doc", "hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        lines = lines.withColumn("place", F.xxhash64("hash", "pos")).where(maybe_in(places, "place"))
        return lines.select("doc", "hash", "pos", *[F.trim(form(F.col("line"))).alias(f"form{i}") for i, form in enumerate(forms)])
    split = F.arrays_zip(*[F.split(form(F.col("text")), "\n").alias(f"form{i}") for i, form in enumerate(forms)])
    lines = named.select("doc", "hash", F.posexplode(split).alias("pos", "line"))
    return lines.select("doc", "hash", "pos", *[F.trim(f"line.form{i}").alias(f"form{i}") for i in range(len(forms))])


def _spaced(c: Column) -> Column:
    return F.regexp_replace(c, SPACES, " ")


def _masked(c: Column) -> Column:
    return _spaced(F.regexp_replace(c, "[0-9]+", "0"))


def _parsed(docs: DataFrame, id_col: str, text_col: str, by_similarity: bool, places: DataFrame | None = None) -> DataFrame:
    """(doc, hash, pos, norm, n, line1, line2, leaf) of the lines that can be templates: long enough, not mere figures.

    norm: the line's tokens, single-spaced, runs of digits as 0; line1 and line2 are its hashes, leaf that of its
    number of tokens and first tokens.
    """
    if by_similarity:
        return _worded(docs, id_col, text_col, places)
    lines = _split(docs, id_col, text_col, places, _masked).withColumnRenamed("form0", "norm")
    count = lambda mark: F.length("norm") - F.length(F.replace("norm", F.lit(mark)))
    lines = lines.withColumn("n", count(" ") + 1).where((F.col("n") >= MIN_TOKENS) & (2 * count("0") <= F.col("n")))
    return lines.select("*", F.xxhash64("norm").alias("line1"), F.xxhash64("norm", F.lit(1)).alias("line2"),
                        F.xxhash64("n", F.substring_index("norm", " ", DEPTH)).alias("leaf"))


def _worded(docs: DataFrame, id_col: str, text_col: str, places: DataFrame | None) -> DataFrame:
    """As _parsed, but figures are tokens of digits and marks. A line mostly of figures that has a word keeps its
    digits and is a leaf of its own, so that it meets its exact copies only."""
    lines = _split(docs, id_col, text_col, places, _masked, _spaced).withColumnsRenamed({"form0": "masked", "form1": "raw"})
    count = lambda mark: F.length("masked") - F.length(F.replace("masked", F.lit(mark)))
    # No more figures than zeros: the expression is for the few lines with many zeros.
    prose = (2 * count("0") <= F.col("n")) | (2 * F.regexp_count("masked", F.lit(FIGURE)) <= F.col("n"))
    lines = lines.withColumn("n", count(" ") + 1).where(F.col("n") >= MIN_TOKENS).withColumn("prose", prose)
    lines = lines.where(F.col("prose") | F.col("raw").rlike(r"\p{L}")).withColumn("norm", F.when(F.col("prose"), F.col("masked")).otherwise(F.col("raw")))
    leaf = F.when(F.col("prose"), F.xxhash64("n", F.substring_index("norm", " ", DEPTH))).otherwise(F.xxhash64("norm", F.lit("figures")))
    return lines.select("doc", "hash", "pos", "norm", "n", F.xxhash64("norm").alias("line1"), F.xxhash64("norm", F.lit(1)).alias("line2"),
                        leaf.alias("leaf"))


def _wanted(by_line: DataFrame) -> DataFrame:
    """Rows of by_line in leaves that several lines of several documents reach."""
    leaves = cut(by_line.groupBy("leaf").agg(F.count("*").alias("lines"), F.min("first").alias("first"), F.max("last").alias("last"))
                 .where("lines > 1 and first != last").select("leaf"), "leaves")
    return cut(by_line.where(maybe_in(bitmap(leaves, "leaf"), "leaf")).join(leaves, "leaf", "left_semi"), "wanted")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, by_similarity: bool) -> DataFrame:
    """(line1, line2, norm, leaf, first, last) of the wanted lines, each read where it stands once."""
    some = _parsed(docs, id_col, text_col, by_similarity, bitmap(wanted, "place")).select(*LINE, "norm", "leaf")
    # Other lines at these places by chance have no match; found twice, a line is the same text.
    return some.dropDuplicates(list(LINE)).join(wanted.select(*LINE, "first", "last"), list(LINE))


def _spelled(texts: DataFrame) -> DataFrame:
    return texts.select(*LINE, "leaf", "first", "last", F.posexplode(F.split("norm", " ")).alias("at", "token"))


def _tokens(texts: DataFrame) -> DataFrame:
    words = F.split("norm", " ")
    spelled = texts.select(*LINE, "leaf", "first", "last", F.size(words).alias("n"), F.posexplode(words).alias("at", "token"))
    return cut(spelled.select(*LINE, "first", "last", "n", "at", F.xxhash64("leaf", "at", "token").alias("key"),
                              F.xxhash64("leaf", "at", "token", F.lit("second")).alias("key2")), "tokens")


def _differ(n: str) -> Column:
    """So many tokens may differ at most in lines of n that are alike."""
    return F.floor((1 - SIMILARITY) * F.col(n) + F.lit(1e-9)).cast("int")


def _segments(tokens: DataFrame) -> DataFrame:
    """(line1, line2, segment, bucket, first): a line's tokens in one segment more than may differ, each with its hash."""
    segment = F.floor((F.col("at") - DEPTH) * (_differ("n") + 1) / (F.col("n") - DEPTH)).cast("int")
    return cut(tokens.where(F.col("at") >= DEPTH).groupBy(*LINE, segment.alias("segment")).agg(
        F.bit_xor("key").alias("bucket"), F.min("first").alias("first")), "segments")


def _compared(met: DataFrame, texts: DataFrame) -> DataFrame:
    """(line1, line2, keeper) for both lines of the pairs (line1, line2, hub1, hub2) that agree in most tokens."""
    own, other = texts.select(*LINE, "norm", "first"), texts.select(F.col("line1").alias("hub1"), F.col("line2").alias("hub2"),
                                                                    F.col("norm").alias("hub"), F.col("first").alias("hub_first"))
    both = met.where("line1 != hub1 or line2 != hub2").distinct().join(own, list(LINE)).join(other, ["hub1", "hub2"])
    same = F.zip_with(F.split("norm", " "), F.split("hub", " "), lambda a, b: F.when(a == b, 1).otherwise(0))
    near = both.where(F.aggregate(same, F.lit(0), lambda n, x: n + x) >= SIMILARITY * F.size(same))
    keeper = F.least("first", "hub_first").alias("keeper")
    pairs = F.array(F.struct(*LINE, keeper), F.struct(F.col("hub1").alias("line1"), F.col("hub2").alias("line2"), keeper))
    return near.select(F.explode(pairs).alias("p")).select("p.*").groupBy(*LINE).agg(F.min("keeper").alias("keeper"))


def _alike(texts: DataFrame, segments: DataFrame) -> DataFrame:
    """(line1, line2, keeper): the least document of a line that agrees with this one in most tokens, if it is the first
    one of some segment."""
    hubs = (segments.groupBy("bucket", F.pmod(F.xxhash64("line1", "segment"), F.lit(HUBS)).alias("of"))
            .agg(F.min(F.struct("first", *LINE)).alias("hub"), F.count("*").alias("n")))
    # A hub that is alone in its bucket is met by nobody.
    shared = cut(hubs.join(hubs.groupBy("bucket").agg(F.sum("n").alias("all")).where("all > 1"), "bucket").select("bucket", "hub"), "hubs")
    met = (segments.where(maybe_in(bitmap(shared, "bucket"), "bucket")).join(shared, "bucket")
           .select(*LINE, F.col("hub.line1").alias("hub1"), F.col("hub.line2").alias("hub2")))
    return _compared(met, texts)


def _open(rows: DataFrame, losing: DataFrame) -> DataFrame:
    """Rows with ``open``: whether the line is not known to be like an earlier document's."""
    known = losing.select(*LINE, "keeper")
    return rows.join(known, list(LINE), "left").withColumn("open", F.coalesce(F.col("keeper") >= F.col("first"), F.lit(True))).drop("keeper")


def _parted(texts: DataFrame, segments: DataFrame, losing: DataFrame) -> DataFrame:
    """(line1, line2, keeper) for the lines left open, so that no pair of lines alike is missed.

    A segment's open lines are compared with all earlier lines of it if they are few. Where many are open, they are
    compared with its first line, and all its lines then parted again: the tokens that vary in it and were not yet equal
    make segments, one more than may differ, one of which two lines alike share. This ends where no more tokens vary
    than may differ, as all lines there are like the first. Crowds without an open line are left.
    """
    words = texts.select(*LINE, F.transform(F.split("norm", " "), lambda w: F.xxhash64(w)).alias("words"))
    rows, found = _open(segments, losing), []
    spelled = False
    while True:
        crowds = (rows.groupBy("bucket").agg(F.count_if("open").alias("n_open"), F.min(F.struct("first", *LINE)).alias("hub"),
                                             F.max(F.when(F.col("open"), F.col("first"))).alias("latest")).where("hub.first < latest"))
        rows = cut(rows.join(crowds, "bucket"), "crowds")
        few = rows.where(F.col("n_open") <= CROWD)
        earlier = few.select("bucket", F.col("first").alias("hub_first"), F.col("line1").alias("hub1"), F.col("line2").alias("hub2"))
        met = (few.where("open").join(earlier, "bucket").where("hub_first < first").select(*LINE, "hub1", "hub2")
               .unionByName(rows.where((F.col("n_open") > CROWD) & F.col("open"))
                            .select(*LINE, F.col("hub.line1").alias("hub1"), F.col("hub.line2").alias("hub2"))))
        found.append(cut(_compared(met, texts), "compared"))
        crowd = rows.where(F.col("n_open") > CROWD)
        if crowd.isEmpty():
            break
        if not spelled:
            crowd = crowd.join(words, list(LINE)).withColumn("differ", F.floor((1 - SIMILARITY) * F.size("words") + F.lit(1e-9)).cast("int"))
            places, size, spelled = F.sequence(F.lit(DEPTH), F.size("words") - 1), F.size("words") - DEPTH, True
            crowd = crowd.withColumn("free", F.filter(places, lambda at: F.floor((at - DEPTH) * (F.col("differ") + 1) / size) != F.col("segment")))
        was = crowd.drop("n_open", "hub", "latest").withColumnRenamed("open", "was")
        crowd = cut(_open(was, found[-1]).withColumn("open", F.col("open") & F.col("was")).drop("was"), "crowd")
        tokens = crowd.select("bucket", "words", F.explode("free").alias("at")).select("bucket", "at", F.element_at("words", F.col("at") + 1).alias("token"))
        vary = (tokens.groupBy("bucket", "at").agg(F.min("token").alias("a"), F.max("token").alias("b")).where("a != b")
                .groupBy("bucket").agg(F.array_sort(F.collect_list("at")).alias("free")))
        crowd = crowd.drop("free").join(vary, "bucket").where(F.size("free") > F.col("differ"))
        crowd = crowd.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("differ"))))
        mine = F.filter("free", lambda at, i: F.floor(i * (F.col("differ") + 1) / F.size("free")) == F.col("segment"))
        crowd = crowd.withColumn("mine", mine)
        bucket = F.xxhash64("bucket", "segment", F.transform("mine", lambda at: F.element_at("words", at + 1)))
        rows = crowd.withColumn("bucket", bucket).withColumn("free", F.array_except("free", "mine")).drop("mine")
    return reduce(DataFrame.unionByName, found)


def _variants(tokens: DataFrame) -> DataFrame:
    """(line1, line2, x, y, first, last): the templates that a line may have, x and y being hashes of the constant tokens.

    With one token left out, or with all that fewer lines have than some number. A token that no other line has is
    no constant, so that a line with two of these needs no template that leaves out just one.
    """
    held = tokens.join(tokens.groupBy("key").agg(F.count("*").alias("held")), "key")
    line = Window.partitionBy(*LINE)
    rare = line.orderBy("held").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    held = held.select("*", F.bit_xor("key").over(line).alias("x"), F.bit_xor("key2").over(line).alias("y"),
                       F.count(F.when(F.col("held") == 1, 1)).over(line).alias("own"), F.count("*").over(rare).alias("rare"),
                       F.bit_xor("key").over(rare).alias("rare_x"), F.bit_xor("key2").over(rare).alias("rare_y"))
    but_one = (F.col("at") >= DEPTH) & ((F.col("own") == 0) | ((F.col("own") == 1) & (F.col("held") == 1)))
    but_rare = F.col("n") - F.col("rare") >= SIMILARITY * F.col("n")
    less = lambda x, y: F.struct(F.col("x").bitwiseXOR(F.col(x)).alias("x"), F.col("y").bitwiseXOR(F.col(y)).alias("y"))
    found = F.array_compact(F.array(F.when(but_one, less("key", "key2")), F.when(but_rare, less("rare_x", "rare_y"))))
    return cut(held.select(*LINE, "first", "last", F.explode(found).alias("t")).select(*LINE, "t.x", "t.y", "first", "last").distinct(), "variants")


def _generalised(spelled: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line1, line2, x, y, first, last) for lines with variable fields; x and y are the template's hashes: those of its
    constant tokens, whose places in the leaf leave the fields' places."""
    tokens = cut(spelled.select(*LINE, "first", "last", F.xxhash64("leaf", "at", "token").alias("key")), "tokens")
    constant = (tokens.groupBy("key").agg(F.min("first").alias("a"), F.max("last").alias("b"))
                .where("a != b").select(F.col("key").alias("constant")))
    held = tokens.select(*LINE, "key").join(constant, F.col("key") == F.col("constant"), "left").select(*LINE, "constant")
    second = F.when(F.col("constant").isNotNull(), F.xxhash64("constant", F.lit("second")))
    found = held.groupBy(*LINE).agg(
        F.count("*").alias("n"), F.count("constant").alias("constants"), F.bit_xor("constant").alias("x"), F.bit_xor(second).alias("y"))
    found = found.where((F.col("constants") < F.col("n")) & (F.col("constants") >= SIMILARITY * F.col("n"))).drop("n", "constants")
    return cut(found.join(wanted.select(*LINE, "first", "last"), list(LINE)), "templates")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_similarity: bool = False) -> DataFrame:
    """The input's columns, the text without dropped lines, with ``n_lines`` and ``n_dropped``.

    A line of MIN_TOKENS tokens or more goes if its template occurs in another document with a smaller id.
    Shorter lines, lines of mere figures and blank lines always stay. Lines are split at ``\\n``. With ``by_similarity``
    a line may have several templates, and goes if one of them does; the line that it is like may go for another one.

    Rows with one doc_id are one document; repeated rows are treated alike. Rows without doc_id are left as they
    are and don't count. A null text stays null with 0 lines; an empty table gives an empty table. Columns of the
    input named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    seen = cut(_parsed(docs, id_col, text_col, by_similarity).select("doc", "hash", "pos", *LINE, "leaf"), "lines")
    # One of a line's places, for reading it there once more.
    by_line = cut(seen.groupBy(*LINE).agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.max("leaf").alias("leaf"),
                                          F.max(F.xxhash64("hash", "pos")).alias("place")), "by_line")
    wanted = _wanted(by_line)
    texts = _texts(docs, wanted, id_col, text_col, by_similarity)
    exact = by_line.where("first != last").select(*LINE, F.col("first").alias("keeper"))
    if by_similarity:
        texts = cut(texts, "texts")
        tokens = _tokens(texts)
        general = _variants(tokens)
        segments = _segments(tokens)
        exact = exact.unionByName(_alike(texts, segments))
    else:
        general = _generalised(_spelled(texts), wanted)
        exact = exact.join(general, list(LINE), "left_anti")
    keepers = general.groupBy("x", "y").agg(F.min("first").alias("keeper"), F.max("last").alias("end")).where("keeper != end")
    losing = general.join(keepers, ["x", "y"]).select(*LINE, "keeper").unionByName(exact)
    if by_similarity:
        losing = cut(losing.groupBy(*LINE).agg(F.min("keeper").alias("keeper")), "losing_first")
        losing = losing.unionByName(_parted(texts, segments, losing)).groupBy(*LINE).agg(F.min("keeper").alias("keeper"))
    losing = cut(losing, "losing")
    drops = cut(seen.where(maybe_in(bitmap(losing, *LINE), *LINE)).join(losing, list(LINE)).where("doc != keeper")
                .groupBy("doc", "hash").agg(F.collect_set("pos").alias("__llm_drop"))
                .withColumnRenamed("doc", "__llm_doc").withColumnRenamed("hash", "__llm_hash"), "drops")
    text = F.col(f"`{text_col}`")
    named = docs.withColumn("__llm_own", F.xxhash64(text))
    # Only documents that may lose lines are shuffled to meet their lists.
    hit = maybe_in(bitmap(drops.select("__llm_hash"), "__llm_hash"), "__llm_own")
    joined = named.where(hit).join(drops, (F.col(f"`{id_col}`") == F.col("__llm_doc")) & (F.col("__llm_own") == F.col("__llm_hash")), "left")
    rest = named.where(~hit).withColumn("__llm_drop", F.lit(None).cast("array<int>"))
    joined = joined.select(*rest.columns).unionByName(rest)
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__llm_drop"))
    kept = F.when(F.col("__llm_drop").isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n"))
    return joined.select(*[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                         F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                         F.coalesce(F.size("__llm_drop"), F.lit(0)).cast("long").alias("n_dropped"))
