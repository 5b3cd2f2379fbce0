"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A paragraph is a line. Its leaves are runs of up to eight words (fewer where one ends a sentence)
with their white space, each hashed with SHA-256; the paragraph's node is the SHA-256 of its leaves'
hashes. A section is a run of paragraphs that begins where a paragraph's node begins with 0 or 1,
about every eighth one; since the text itself sets the borders, an edit moves no border but those
beside it. A section's node is the SHA-256 of its paragraphs', the root that of the sections'.

The fingerprint is the root, a semicolon, and the tree down to the first 64 bits of every leaf: a bar
between sections, a comma between paragraphs. Equal roots mean equal texts. Two fingerprints are
compared from the top: sections that both have are alike with all that is below them; of the others'
paragraphs those that both have; of the remaining paragraphs the leaves that both have. The likeness
is the Dice coefficient: leaves of branches found in both, of all leaves, each distinct branch
counted once. Leaves in another order are as like as in the same; only equal roots tell.

Defined cases: a null text is empty; an empty text has one empty paragraph and no leaf; two
texts without leaves have likeness 1 if their roots are equal, else 0. Rows with a null id
come after all others. Rows that repeat another's id and text share one place in the order
and each give a row. A table of one document has itself as its next; an empty table gives an
empty result. Extra columns are left out. Built-in functions only.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.html import bound
from .storage import ordered

#: Up to eight words, fewer where one ends a sentence, with the white space around them.
LEAF = r"\s*+(?:\S++(?<![.!?])\s++){0,7}\S++\s*+|\s++"


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n")


#: Hexadecimal digits of a leaf in a fingerprint.
LEAF_DIGITS = 16


def _paragraph(line: Column) -> Column:
    """A paragraph's node, and after a colon what the fingerprint keeps of its leaves."""
    leaves = F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), lambda x: F.sha2(x, 256))
    return bound(F.array_join(leaves, ""), lambda joined: F.concat(
        F.sha2(joined, 256), F.lit(":"),
        F.regexp_replace(joined, f"(.{{{LEAF_DIGITS}}}).{{{64 - LEAF_DIGITS}}}", "$1")))


def tree(text: Column) -> Column:
    """``root``, ``sections`` (each of ``hash`` and its ``paragraphs``' hashes in order), and
    ``fingerprint``."""
    found = F.array_join(F.transform(paragraphs(text), _paragraph), " ")
    # the nodes as one string are cut before those that open a section: linear time
    whole = F.transform(F.split(found, " (?=[01])"), lambda s: F.struct(
        F.regexp_replace(s, ":[0-9a-f]*", "").alias("nodes"),
        F.substr(F.regexp_replace(s, "(?:^| )[^:]*+:", ","), F.lit(2)).alias("leaves")))
    sections = F.transform(whole, lambda s: F.struct(
        F.sha2(s["nodes"], 256).alias("hash"), F.split(s["nodes"], " ").alias("paragraphs"), s["leaves"].alias("leaves")))
    return bound(sections, lambda found: F.struct(
        root_of(found["hash"]).alias("root"), found.alias("sections"),
        F.concat(root_of(found["hash"]), F.lit(";"), F.array_join(found["leaves"], "|")).alias("fingerprint")))


def root_of(hashes: Column) -> Column:
    return F.sha2(F.concat_ws(" ", hashes), 256)


def _n_leaves(branches: Column) -> Column:
    return F.length(F.translate(F.array_join(branches, ""), ",", "")) / LEAF_DIGITS


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two fingerprints, by descending into branches that differ."""
    def levels(top):
        return F.struct(_n_leaves(F.array_intersect(top["a"], top["b"])).alias("shared"),
                        *_apart(top["a"], top["b"], ",", ","))

    def below(found):
        return F.struct((found["shared"] + _n_leaves(F.array_intersect(found["a"], found["b"]))).alias("shared"),
                        *_apart(found["a"], found["b"], f"(?<=\\G.{{{LEAF_DIGITS}}})", ""))

    def settled(found):
        x, y = (F.array_distinct(F.array_remove(found[c], "")) for c in "ab")
        return F.struct((found["shared"] + F.size(F.array_intersect(x, y))).alias("shared"),
                        (2 * found["shared"] + F.size(x) + F.size(y)).alias("both"))

    def graded(found):
        return F.when(found["both"] == 0, F.lit(0.0)).otherwise(2.0 * found["shared"] / found["both"])
    pair = F.struct(*[F.split(F.substring_index(x, ";", -1), r"\|").alias(name) for x, name in ((a, "a"), (b, "b"))])
    return F.when(F.substring_index(a, ";", 1) == F.substring_index(b, ";", 1), F.lit(1.0)).otherwise(
        bound(bound(bound(bound(pair, levels), below), settled), graded))


def _apart(a: Column, b: Column, cut: str, glue: str) -> list[Column]:
    """What is below the branches that only one has, each distinct branch once."""
    return [F.split(F.array_join(F.array_except(x, y), glue), cut).alias(name)
            for x, y, name in ((a, b, "a"), (b, a, "b"))]


def changes(a: Column, b: Column) -> Column:
    """Where tree ``a`` differs from ``b``: hashes of its ``sections`` that ``b`` lacks, and
    of ``paragraphs`` in those that are in none of the sections only ``b`` has."""
    def only(x, y):
        return F.array_except(x["sections"]["hash"], y["sections"]["hash"])

    def nodes(x, y):
        lacking = F.map_from_entries(F.transform(only(x, y), lambda h: F.struct(h, F.lit(True))))
        inside = F.filter(x["sections"], lambda s: F.element_at(lacking, s["hash"]).isNotNull())
        return F.flatten(inside["paragraphs"])
    return F.struct(only(a, b).alias("sections"),
                    F.array_except(nodes(a, b), nodes(b, a)).alias("paragraphs"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` to ``doc_id, fingerprint, tree`` (a map-only step)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.inline(F.array(F.struct(tree(text).alias("tree"))))).select(
        "doc_id", "tree.fingerprint", "tree")


def predecessors(keys: DataFrame) -> DataFrame:
    """``doc_id, key, half`` (distinct) to ``key, prev_key, prev_half`` by descending id.

    The predecessor of the first is the last, so each key is the predecessor of one.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").desc()]
    parts, _ = ordered(keys, *order, name="fingerprint-order")
    within = Window.partitionBy("part").orderBy(*order)
    rows = parts.select("part", "key", *[
        F.lag(c).over(within).alias(f"prev_{c}") for c in ("key", "half")])
    # the last row of each range, by the same order, as a maximum: hex digits are turned round
    ends = parts.groupBy("part").agg(
        F.max(F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"),
                       F.translate("key", "0123456789abcdef", "fedcba9876543210").alias("turned"),
                       "key", "half")).alias("end"))
    by_part = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding,
                                               Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("end").over(by_part),
                                          F.last("end").over(whole)).alias("end"))
    return rows.join(F.broadcast(ends), "part").select(
        "key", F.coalesce("prev_key", "end.key").alias("prev_key"),
        F.coalesce("prev_half", "end.half").alias("prev_half"))


def with_next(docs: DataFrame) -> DataFrame:
    """Each document beside the fingerprint of the next and that one's first characters.

    ``doc_id, text`` to ``doc_id, key, text, next_id, head, next_fingerprint``; ``head`` has half
    the length of ``text``, or the whole next text. Texts move once, heads and fingerprints once.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text")).withColumn("key", F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), "text")))
    chain = predecessors(named.select("doc_id", "key", F.floor(F.length("text") / 2)
                                      .cast("int").alias("half")).distinct())
    # both uses below read the same columns, so that Spark shuffles the texts once for both
    first = F.lag("key").over(Window.partitionBy("key").orderBy("key")).isNull()
    givers = named.withColumn("first", first).where("first").join(chain, "key").select(
        F.col("prev_key").alias("key"), F.col("doc_id").alias("next_id"),
        F.expr("substring(text, 1, prev_half)").alias("head"),
        tree(F.col("text"))["fingerprint"].alias("next_fingerprint"))
    return named.join(givers, "key")


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how near they are.

    The edited text has the second half of its code points replaced by as many first ones of
    the next document in descending order of id.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), "head")
    pairs = with_next(docs).withColumn("edited", edited)
    found = pairs.select(
        "doc_id", "text", "edited", "next_id", "next_fingerprint", F.inline(F.array(F.struct(
            tree(F.col("text")).alias("tree"), tree(F.col("edited")).alias("edited_tree")))))
    own, other = F.col("tree.fingerprint"), F.col("edited_tree.fingerprint")
    return found.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        own.alias("fingerprint"), other.alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
        F.size(changes(F.col("tree"), F.col("edited_tree"))["sections"]).alias("n_sections_changed"), "next_id")
