"""Revisions derived from plain text tables.

``conversations`` become pages with one revision per turn and ``documents`` become pages with
one revision.  The tables hold no wikitext, so markup is woven into their whole texts by a
SQL expression; it only uses functions that other SQL engines share, which lets a check run
on the same texts elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.revisions import with_last_flag


def _cat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _txt(sql: str) -> str:
    return f"CAST({sql} AS STRING)"


NL = "chr(10)"

# One revision of the page made from a conversation.  Some turns have no markup at all and
# some have no text, as deleted revisions do.
CONVERSATION_TEXT = f"""
CASE
WHEN conv_id % 11 = 5 AND turn % 4 = 3 THEN NULL
WHEN conv_id % 7 = 3 AND turn % 3 = 1 THEN text
ELSE {_cat(
    "'Lead by [[', role, ']] and [[Talk:'", _txt("conv_id"), "'|the page'", NL, "'of '",
    _txt("conv_id"), "']].<!-- hidden 10.9999/no [[no]] {{no}} '", NL, "'== no == -->'", NL,
    f"CASE WHEN turn % 2 = 0 THEN {_cat(chr(39) + 'arXiv:0704.' + chr(39), _txt('1000 + conv_id % 50'), chr(39) + 'v2' + chr(39), NL)} ELSE '' END",
    "'== Overview =='", NL, NL, "text", NL,
    "'{{cite journal|doi=10.1000/d'", _txt("(turn * 7 + conv_id) % 3"), "'|isbn=0-19-85'",
    _txt("conv_id % 10"), "'3-'", _txt("turn % 2"), "'}}'", NL,
    "'=== '", "CASE conv_id % 4 WHEN 0 THEN 'History' WHEN 1 THEN 'Early life' WHEN 2 THEN 'REFERENCE' ELSE ' Plot' END",
    "' ==='", NL,
    "'A claim.<ref name=\"r'", _txt("conv_id % 4"), "'\">{{cite|doi=10.2000/r'", _txt("conv_id % 5"),
    "'.'", _txt("turn % 3"), "'|pmc=PMC'", _txt("100 + conv_id % 7"),
    "'}} at [http://arxiv.org/abs/math.GT/030'", _txt("9000 + conv_id % 9"), "'v1]</ref>'", NL,
    "'see [[File:p'", _txt("conv_id"), "'.png|thumb|[[inner '", _txt("turn"), "'|in]] cap]]'", NL,
    "'== '",
    "CASE (conv_id + turn) % 6 WHEN 0 THEN 'References' WHEN 1 THEN 'Refernces'"
    " WHEN 2 THEN 'Notes and references' WHEN 3 THEN 'Further reading' WHEN 4 THEN 'See also'"
    " ELSE '  sources' END",
    "' =='", NL,
    "'<REF>pmid = '", _txt("500 + (conv_id + turn) % 4"), "' doi:10.3000/q'",
    _txt("(conv_id + 2 * turn) % 5"), "'.</ref> ISBN 978'", _txt("conv_id % 3"),
    "'X and http://www.ncbi.nlm.nih.gov/pubmed/'", _txt("700 + turn % 3"),
    "' https://www.ncbi.nlm.nih.gov/pmc/articles/PMC'", _txt("800 + conv_id % 2"), NL,
    "'= Links ='", NL, "'[[ Main page ]] [[|piped '", _txt("turn"), "']] [[a#b]] <ref open'",
)}
END
"""

# A document as an article: a reference per sentence, a link per clause, a section per line.
DOCUMENT_TEXT = _cat(
    f"""replace(replace(replace(text,
        '. ', {_cat("'.<ref>{{cite book|isbn=978-'", _txt("doc_id % 100"), "'|doi=10.5555/s'", _txt("doc_id % 50"), "'}}</ref> '")}),
        ', ', {_cat("', [['", "lang", "' word|'", "source", "']] '")}),
        {NL}, {_cat(NL, "'== Part from '", "source", "' =='", NL)})""",
    NL, "'== '",
    "CASE doc_id % 5 WHEN 0 THEN 'References' WHEN 1 THEN 'bibliography' WHEN 2 THEN 'Foot notes'"
    " WHEN 3 THEN 'External links' ELSE 'Literature cited' END",
    "' =='", NL, "'* {{cite|arxiv=1501.'", _txt("10000 + doc_id % 1000"), "'|pmid='",
    _txt("doc_id"), "'}} <!-- end -->'", NL,
)

# Order of turns in time: every fourth conversation swaps neighbours, another fourth has two
# revisions in the same hour, half of these with the ids swapped.  Some ids occur twice.
CONVERSATION_HOUR = """
CASE conv_id % 4
WHEN 1 THEN CASE WHEN turn % 2 = 0 THEN turn + 1 ELSE turn - 1 END
WHEN 2 THEN CAST(floor(turn / 2) AS BIGINT)
ELSE turn END
"""
CONVERSATION_REV_ID = """
conv_id * 1000 + 1 + CASE WHEN conv_id % 19 = 7 AND turn = 5 THEN 0 WHEN conv_id % 8 = 2
THEN CASE WHEN turn % 2 = 0 THEN turn + 1 ELSE turn - 1 END ELSE turn END
"""
CONVERSATION_PARENT_ID = """
CASE WHEN turn = 0 THEN NULL WHEN conv_id % 13 = 4 AND turn = 3 THEN conv_id * 1000 + 999
ELSE conv_id * 1000 + turn END
"""
CONVERSATION_NS = "CASE WHEN conv_id % 10 = 9 THEN 1 ELSE 0 END"
CONVERSATION_FILE = _cat("'history-'", _txt("conv_id % 3"))
CONVERSATION_TITLE = _cat("'Page '", _txt("conv_id"))
CONVERSATION_USER_ID = "CASE WHEN (conv_id + turn) % 3 = 1 THEN 10 + turn END"
CONVERSATION_USER_TEXT = (
    f"CASE (conv_id + turn) % 3 WHEN 1 THEN {_cat(chr(39) + 'User ' + chr(39), _txt('turn'))}"
    f" WHEN 2 THEN {_cat(chr(39) + '10.0.0.' + chr(39), _txt('turn'))} END"
)
CONVERSATION_COMMENT = f"CASE WHEN turn % 2 = 0 THEN {_cat(chr(39) + 'edit ' + chr(39), _txt('turn'))} END"
CONVERSATION_MODEL = "CASE WHEN conv_id % 17 = 16 AND turn = 1 THEN '7 bad model' ELSE 'wikitext' END"
FIRST_TIMESTAMP = "TIMESTAMP '2015-01-01 00:00:00'"
FIRST_INSTANT = "TIMESTAMP '2015-01-01T00:00:00Z'"


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of an input to at least as many tasks as there are cores.

    Text work costs far more than moving its input once.  How many read tasks are planned does
    not tell how many have rows: they are cut by bytes, but a row group goes to one task whole.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, rows.rdd.getNumPartitions()), *keys)


def _table(spark: SparkSession, directory: str, name: str, *keys: str) -> DataFrame:
    return spread(spark.read.parquet(f"{directory}/{name}.parquet"), *keys)


def web_pages(spark: SparkSession, directory: str) -> DataFrame:
    return _table(spark, directory, "pages", "page_id")


def conversation_revisions(
    spark: SparkSession, directory: str, last_flag: bool = False
) -> DataFrame:
    """``conversations`` as revisions of one page each.

    ``last_flag`` adds ``is_last`` before any text is built, from the narrow columns.
    """
    user_text = F.expr(CONVERSATION_USER_TEXT)
    table = _table(spark, directory, "conversations", "conv_id", "turn")
    keyed = table.select(
        F.expr(CONVERSATION_FILE).alias("source_file"),
        F.col("conv_id").alias("page_id"),
        F.col("turn").cast("int").alias("rev_pos"),
        "conv_id",
        "turn",
        "role",
        "text",
    )
    if last_flag:
        keyed = with_last_flag(keyed)
    return keyed.select(
        "source_file",
        "page_id",
        F.expr(CONVERSATION_NS).cast("int").alias("ns"),
        F.expr(CONVERSATION_TITLE).alias("page_title"),
        "rev_pos",
        F.expr(CONVERSATION_REV_ID).alias("rev_id"),
        F.expr(CONVERSATION_PARENT_ID).alias("parent_id"),
        F.expr(f"timestampadd(HOUR, {CONVERSATION_HOUR}, {FIRST_INSTANT})").alias("ts"),
        F.when(
            user_text.isNotNull(),
            F.struct(F.expr(CONVERSATION_USER_ID).alias("id"), user_text.alias("text")),
        ).alias("user"),
        (F.col("turn") % 3 == 1).alias("minor"),
        F.expr(CONVERSATION_COMMENT).alias("comment"),
        F.expr(CONVERSATION_MODEL).alias("model"),
        F.lit("text/x-wiki").alias("format"),
        F.expr(CONVERSATION_TEXT).alias("text"),
        *(["is_last"] if last_flag else []),
    )


def document_articles(spark: SparkSession, directory: str) -> DataFrame:
    """``documents`` as articles with a single revision."""
    return _table(spark, directory, "documents", "doc_id").select(
        F.concat(F.lit("articles-"), F.col("source")).alias("source_file"),
        F.col("doc_id").alias("page_id"),
        F.lit(0).alias("ns"),
        F.concat(F.lit("Article "), F.col("doc_id").cast("string")).alias("page_title"),
        F.lit(0).alias("rev_pos"),
        (F.col("doc_id") + 1).alias("rev_id"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.expr(FIRST_INSTANT).alias("ts"),
        F.lit(None).cast("struct<id:bigint,text:string>").alias("user"),
        F.lit(False).alias("minor"),
        F.lit(None).cast("string").alias("comment"),
        F.lit("wikitext").alias("model"),
        F.lit("text/x-wiki").alias("format"),
        F.expr(DOCUMENT_TEXT).alias("text"),
        F.lit(True).alias("is_last"),
        F.lit(0).alias("chrono_pos"),
    )
