"""The article tables, derived from the test tables.

Every derivation reads its whole table. Whatever is chosen per row (wrapping,
kind of href, ...) follows from the row's own text.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

# Prefixes of the example blacklist.
BLACKLIST = (
    "http://www.cheap-pills.example.com/",
    "https://www.cheap-pills.example.com/",
    "https://spam-farm.example.org",
    "http://spam-farm.example.org/",
    "http://m.casino-win.example.com/en",
    "https://cdn.example.net/a/The",
    "http://www.src3.example.com/news/",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blacklist(spark: SparkSession) -> DataFrame:
    """The example blacklist as a table. An SQL VALUES list, so that its size is
    known to the planner."""
    rows = ", ".join(f"('{url}')" for url in BLACKLIST)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS blacklist(url)")


def host_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blacklist that grows with the pages: the German section of every host."""
    prefix = F.regexp_extract("url", "^(https?://[^/]+/de/)", 1)
    return table(spark, sf_dir, "pages").select(prefix.alias("url")).filter("url <> ''").distinct()


def word_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blacklist that grows with the documents, all of it on one host: a folder for every word that ends a sentence."""
    # Words are only tried from their first character on, which is where the leftmost match begins.
    word = F.explode(F.regexp_extract_all("text", F.lit("(?<![^ \n.])([^ \n.]++)[.]"), F.lit(1)))
    return table(spark, sf_dir, "documents").select(word.alias("word")).distinct().select(
        F.concat(F.lit("https://cdn.example.net/a/"), "word").alias("url"))


def ending_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that grow with the documents: the last two words of every exclamation."""
    # No match goes beyond a sentence or line, so those without a mark are left out first. In the others a match
    # begins where a word does or the last match ended; other places need not be tried.
    marked = F.filter(F.split("text", "[\n.]"), lambda sentence: F.contains(sentence, F.lit("!")))
    terms = F.flatten(F.transform(marked, lambda sentence: F.regexp_extract_all(
        sentence, F.lit(r"(?:\G|(?<![^ ]))([^ ]++ [^ ]+)!"), F.lit(1))))
    return table(spark, sf_dir, "documents").select(F.explode(terms).alias("term")).distinct()


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site registry, a row per supplier; the names match documents.source. One
    site has a broken host, one no base address."""
    name = F.concat(F.lit("src"), F.col("s_suppkey"))
    host = F.when(F.col("s_suppkey") == 4, F.lit("http://[broken")).otherwise(
        F.concat(F.lit("http://www."), name, F.lit(".example.com"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), name.alias("Name"), F.concat(host, F.lit("/latest")).alias("url"),
        F.when(F.col("s_suppkey") != 5, F.concat(host, F.lit("/"))).alias("baseUrl"), (F.col("s_acctbal") >= 1000).alias("isExecute"),
    )


def team_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team registry, a row per customer."""
    host = F.concat(F.lit("http://team"), F.col("c_custkey"), F.lit(".example.com"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit("2023-01-01T00:00:00Z").alias("created_at"),
        F.concat(host, F.lit("/news")).alias("url"), host.alias("baseUrl"), F.col("c_name").alias("Team"),
        (F.col("c_mktsegment") == "BUILDING").alias("isExecute"),
    )


def nation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name registry with an id 0 and, per region, names that differ only in case."""
    nation = table(spark, sf_dir, "nation")
    plain = nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("Name"))
    lower = nation.filter("n_regionkey = 1").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("id"), F.lower("n_name").alias("Name")
    )
    return plain.unionByName(lower)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines: every line of every document, with its place."""
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "headline"))


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extraction response per document, an item per line of its text.

    Lines of one word give an item without headline, lines under 20 characters
    one without href. Kinds of href, ids and supplied URLs alternate with the
    line. The language decides how the JSON is wrapped; of 41 documents one has
    an empty and one a cut-off response; a text ending in "|" gets a headline
    that is a number.
    """
    def item(line, pos):
        word = F.substring_index(line, " ", 1)
        n = pos.cast("string")
        kind = F.pmod(pos, F.lit(5))
        href = (
            F.when(kind == 0, F.concat(F.lit("/news/"), word, F.lit(" "), n))
            .when(kind == 1, F.concat(F.lit("https://cdn.example.net/a/"), word, F.lit(";b,c?q="), word, F.lit(" x&n="), n, F.lit("#s "), n))
            .when(kind == 2, F.concat(F.lit("//m.example.org/"), word, F.lit("//"), n, F.lit("/")))
            .when(kind == 3, F.concat(F.lit(" story/"), n, F.lit(".html;v=1")))
            .otherwise(F.concat(F.lit("../"), word, F.lit("%20x")))
        )
        return F.struct(
            F.when(kind == 3, F.concat(F.lit("ID "), word)).alias("id"),
            F.lit("model.example.com").alias("source"),
            F.when(F.contains(line, F.lit(" ")), F.concat(F.lit("\xa0"), line, F.lit("  "))).otherwise(F.lit(" ")).alias("headline"),
            F.when(F.length(line) < 20, F.lit("")).otherwise(href).alias("href"),
            F.when(F.startswith(F.lower(word), F.lit("th")), F.concat(F.lit(" http://spam-farm.example.org/"), n)).alias("url"),
            F.concat(F.lit("2024-01-"), F.lpad((F.pmod(pos, F.lit(28)) + 1).cast("string"), 2, "0")).alias("published_at"),
        )

    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    df = documents.withColumn("items", F.to_json(F.transform(F.split("text", "\n"), item)))
    items = F.when(
        F.endswith(F.col("text"), F.lit("|")),
        F.concat(F.lit('[{"headline": 7, "href": "/x"}, '), F.substring("items", F.lit(2), F.length("items"))),
    ).otherwise(F.col("items"))
    df = df.withColumn("items", items)
    one_object = F.substring("items", F.lit(2), F.length("items") - 2)
    content = (
        F.when(F.col("doc_id") % 41 == 7, F.lit(""))
        .when(F.col("doc_id") % 41 == 8, one_object.substr(F.lit(1), F.length("items") - 4))
        .when(F.col("lang") == "en", F.concat(F.lit("Here you go [1]:\n```json\n"), "items", F.lit("\n```\nSource: [1].")))
        .when(F.col("lang") == "fr", F.concat(F.lit("Résultat : "), "items", F.lit(" fin.")))
        .when(F.col("lang") == "de", F.concat(F.lit('[1, "x", null, '), F.substring("items", F.lit(2), F.length("items"))))
        .when(~F.contains("text", F.lit("\n")), one_object)
        .otherwise(F.col("items"))
    )
    return df.select(
        F.col("doc_id").alias("response_id"), F.col("source").alias("source_name"),
        content.cast("binary").alias("content"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )


def hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages and the hrefs of all their anchors."""
    pages = table(spark, sf_dir, "pages")
    anchors = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return pages.select(
        "page_id", F.col("url").alias("page_url"),
        F.posexplode(F.concat(F.array("url"), anchors)).alias("pos", "href"),
    )
