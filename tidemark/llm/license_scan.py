"""License scans by sentence rules.

A text is cut into sentences, each is normalised (lower case, words only, one space), and sentences
of known licences become identifiers. The sequence of a text's identifiers is then matched against
ordered licence rules, each a sequence of identifiers: the leftmost match wins, at one place the
earlier rule, and what a rule has used is gone. Identifiers that no rule takes are reported as left over.

Comment marks at the ends of lines are dropped. A sentence ends at a full stop, exclamation or question mark before
white space (unless a digit follows, as in "v. 2.0"), at a blank line and at a list number; a single line break is
a space, since licence texts are wrapped. A sentence that is unknown as a whole is tried line by line, so that a notice on
a line of its own is found without a full stop around it.

Everything is DataFrame expressions in one map over the documents, no shuffle. Texts without any of
the ``ANCHORS`` (each known sentence has one) are not cut.

Defined results: null and empty texts have no sentences and no licence; sentences that differ from a
known one in more than case, punctuation or spaces are unknown; repeated rows repeat their result;
a text is ``restricted`` if a licence outside ``PERMISSIVE`` or a left-over sentence is found; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.license_texts import ANCHORS, PERMISSIVE, RULES, SENTENCES

# One after the other: line ends, comment marks, blank lines, list numbers on lines and after marks, ends of sentences.
# Cuts are marked by U+0001.
CUTS = (
    (r"\r\n?|[\x0b\x0c\x{85}\x{2028}\x{2029}\x01]", "\n"),
    (r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|<!--|%+)[ \t]*", ""),
    (r"(?m)[ \t]*(?:\*+/|-->)[ \t]*$", ""),
    (r"\n[ \t]*\n\s*", "\x01"),
    (r"(^|[\n\x01])[ \t]*[(]?(?:[0-9]{1,2}|[a-z])[.)][ \t]+", "\x01"),
    (r"([:;.])[ \n]+[(]?[0-9]{1,2}[.)][ \t]+", "$1\x01"),
    (r"([.!?])[\")]*[ \t\n]+([^0-9 \t\n])", "$1\x01$2"),
)
NOT_WORD = r"[^a-z0-9.]+"
ENDS = r"^[ .]+|[ .]+$"


def normal(sentence: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(sentence, NOT_WORD, " "), ENDS, "")


def sentences_of(low: Column) -> Column:
    """Sentences of a lower-cased text, line breaks still in them."""
    for pattern, by in CUTS:
        low = F.regexp_replace(low, pattern, by)
    return F.split(low, "\x01")


def letters(names) -> dict[str, str]:
    """One letter for each identifier, so that sequences are strings and rules are patterns."""
    return {name: chr(0x100 + i) for i, name in enumerate(dict.fromkeys(names))}


def code_of(sentences=SENTENCES) -> dict[str, str]:
    return letters(i for i, _ in sentences)


def patterns(rules=RULES, sentences=SENTENCES) -> list[tuple[str, str]]:
    code = code_of(sentences)
    return [(name, "".join(code[i] for i in ids)) for name, ids in rules]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences=SENTENCES, rules=RULES,
         permissive=PERMISSIVE, anchors: str = ANCHORS) -> DataFrame:
    """doc_id, sentence identifiers in order, licences in order (repeats stay), left-over identifiers, verdict."""
    code = code_of(sentences)
    known = F.create_map(*[F.lit(x) for i, s in sentences for x in (s, code[i])])
    names = F.create_map(*[F.lit(x) for i, c in code.items() for x in (c, i)])
    taken = patterns(rules, sentences)
    licence = F.create_map(*[F.lit(x) for name, seq in {s: n for n, s in taken}.items() for x in (name, seq)])
    low = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    lookup = lambda x: F.element_at(known, normal(x))
    by_line = lambda x: F.array_join(F.array_compact(F.transform(F.split(x, "\n"), lookup)), "")
    found = F.array_join(F.transform(sentences_of(low), lambda x: F.coalesce(lookup(x), by_line(x))), "")
    base = docs.select(F.col(doc_id).alias("doc_id"), F.when(low.rlike(anchors), found).otherwise("").alias("ids"))
    either = "|".join(seq for _, seq in taken)
    each = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    out = base.select(
        "doc_id",
        F.transform(each("ids"), lambda c: F.element_at(names, c)).alias("sentences"),
        F.transform(F.regexp_extract_all("ids", F.lit(either), F.lit(0)), lambda m: F.element_at(licence, m)).alias("licenses"),
        F.transform(each(F.regexp_replace("ids", either, "")), lambda c: F.element_at(names, c)).alias("left_over"),
    )
    bad = F.exists("licenses", lambda n: ~n.isin(*permissive)) | (F.size("left_over") > 0)
    return out.withColumn("restricted", bad)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.array_join("sentences", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"),
        F.array_join("left_over", ",").alias("left_over"), F.size("licenses").cast("long").alias("n_licenses"), "restricted",
    )
