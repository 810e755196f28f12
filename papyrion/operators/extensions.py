"""Data operators that are only described, not run, by the document pipeline: retrieval and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.functions import text as T
from papyrion.operators.vector import METRICS

OPERATORS = {
    "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v, "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v)),
}


def where(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Rows that meet all conditions: a value, or a mapping from operators to values."""
    for column, wanted in conditions.items():
        for op, value in wanted.items() if isinstance(wanted, Mapping) else [("$eq", wanted)]:
            df = df.where(OPERATORS[op](F.col(column), value))
    return df


def with_neighbours(hits: DataFrame, chunks: DataFrame, window: int = 1) -> DataFrame:
    """Each hit (doc_id, chunk_index, ...) with its text and that of ``window`` chunks on both sides."""
    spread = hits.select("*", F.explode(F.sequence(F.col("chunk_index") - window, F.col("chunk_index") + window)).alias("at"))
    c = chunks.select("doc_id", F.col("chunk_index").alias("at"), "content")
    keys = hits.columns
    joined = spread.join(c, ["doc_id", "at"]).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "content"))).alias("p"))
    return joined.select(*keys, F.array_join("p.content", "\n").alias("context"))


def hybrid_score(content: Column, embedding: Column, query: Sequence[float], keywords: Sequence[str], semantic: float = 0.7, keyword: float = 0.3) -> Column:
    """A weighted sum of cosine similarity and the share of keywords that occur."""
    share = T.count_contained(F.lower(content), [k.lower() for k in keywords]) / max(1, len(keywords))
    return semantic * (1 - METRICS["cosine"](embedding, F.array(*(F.lit(float(x)) for x in query)))) + keyword * share


def expanded(query: Column, suffixes: Mapping[str, str]) -> Column:
    """The query with the suffix of each keyword that it holds."""
    low = F.lower(query)
    return F.concat_ws(" ", query, *(F.when(low.contains(k), F.lit(v)) for k, v in suffixes.items()))


def categories(content: Column, rules: Mapping[str, Sequence[str]]) -> Column:
    """All categories of which some keyword occurs, in the order of the rules."""
    low = F.lower(content)
    return F.filter(F.array(*(F.when(T.contains_any(low, words), name) for name, words in rules.items())), lambda c: c.isNotNull())


def best_category(content: Column, patterns: Mapping[str, Sequence[str]], least: float = 0.3) -> Column:
    """The category with the largest share of its patterns found, or ``unknown`` below ``least``."""
    low = F.lower(content)
    shares = [F.struct((T.count_contained(low, words) / len(words)).alias("share"), F.lit(-i).alias("order"), F.lit(name).alias("name")) for i, (name, words) in enumerate(patterns.items())]
    best = F.array_max(F.array(*shares))
    return F.when(best["share"] >= least, best["name"]).otherwise("unknown")


# Phrases of the compliance checks.
PRIVACY = {
    "privacy_policy": ["privacy policy", "datenschutz"],
    "data_retention": ["data retention", "datenaufbewahrung"],
    "consent_mechanism": ["consent", "einwilligung"],
    "data_subject_rights": ["data subject rights", "betroffenenrechte"],
}
SECURITY = ["information security", "risk management", "security controls", "incident response", "business continuity"]
RISKS = ["confidential", "vertraulich", "sensitive", "personal data", "financial", "legal", "compliance", "audit"]


def compliance(content: Column) -> Column:
    """A struct: privacy and security percentages with their statuses, and the risk score with its level."""
    low = F.lower(content)
    privacy = sum((T.contains_any(low, words).cast("int") for words in PRIVACY.values()), F.lit(0)) * (100 / len(PRIVACY))
    security = T.count_contained(low, SECURITY) * (100 / len(SECURITY))
    risk = T.count_contained(low, RISKS)
    return F.struct(
        privacy.alias("privacy_percent"), F.when(privacy >= 75, "compliant").otherwise("non_compliant").alias("privacy_status"), security.alias("security_percent"), F.when(security >= 60, "compliant").otherwise("partial").alias("security_status"),
        risk.alias("risk_score"), F.when(risk >= 5, "high").when(risk >= 3, "medium").otherwise("low").alias("risk_level"),
    )


def rate(df: DataFrame, passed: Column, *by: str) -> DataFrame:
    """Rows, passed rows and their percentage, overall or by columns."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("passed"))
    return out.withColumn("percent", F.round(100 * F.col("passed") / F.col("n"), 4))


def return_on_content(usage: DataFrame, value: Column, cost: Column, most: int = 10) -> DataFrame:
    """(doc_id, value, cost, roi) of the documents with the best return."""
    sums = usage.groupBy("doc_id").agg(F.sum(value).alias("value"), F.sum(cost).alias("cost"))
    return sums.withColumn("roi", F.try_divide(F.col("value") - F.col("cost"), F.col("cost"))).orderBy(F.desc_nulls_last("roi"), "doc_id").limit(most)


def topics(docs: DataFrame, k: int, terms: int = 1000, top: int = 10, seed: int = 1) -> DataFrame:
    """(cluster, documents, top_terms) of TF-IDF vectors clustered by k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, CountVectorizer
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    words = docs.select("doc_id", T.words(F.lower("content")).alias("w")).where(F.size("w") > 0)
    counted = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=terms).fit(words)
    weighed = (tf := counted.transform(words)) and IDF(inputCol="tf", outputCol="features").fit(tf).transform(tf)
    placed = KMeans(k=k, seed=seed).fit(weighed).transform(weighed)
    # one vector a cluster is made dense, not one a document
    added = placed.groupBy("prediction").agg(Summarizer.sum(F.col("features")).alias("s"), F.count(F.lit(1)).alias("documents"))
    sums = added.select("documents", "prediction", F.posexplode(vector_to_array("s")).alias("term", "x")).where("x > 0")
    w = Window.partitionBy("prediction").orderBy(F.desc("x"), "term")
    vocabulary = F.array(*map(F.lit, counted.vocabulary))
    best = sums.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).groupBy("prediction").agg(F.first("documents").alias("documents"), F.array_sort(F.collect_list(F.struct("place", vocabulary[F.col("term")].alias("t")))).alias("t"))
    return best.select(F.col("prediction").alias("cluster"), "documents", F.array_join("t.t", ",").alias("top_terms"))
