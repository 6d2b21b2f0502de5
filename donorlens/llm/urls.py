"""URL filter: allow and block rules first, then host word segmentation and multinomial naive Bayes.

Parts. The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes on from there
up to ``?``, ``#`` or the end. A null url, or one without ``://``, has neither.

Rules are (host, path, verdict). A rule fits its host and all subdomains if the path starts with the rule's; of several the
one with the longest host, then the longest path wins.

Segmentation. Host and path are cut at everything but letters into names ("cheappills"). Words are counted over the whole html
of all pages (each listed bad word counting once more); a name is split by Viterbi's method into the words of the highest product
of probabilities, an unknown word of n letters counting 10**-n of an unseen one. Only substrings (up to ``MAX_WORD``
letters) of the distinct names are joined with the counts, so the dictionary never has to fit into a task.

Naive Bayes. No table labels urls. A host is taken for bad if its segmented words meet a word list (``SEEDS``, a parameter),
else for good; word counts by class over the words of each distinct host and of all its paths give, with add-one smoothing,
each word's log odds. Names, hosts and paths are scored once each; an url is blocked if the sum of prior and words is
over 0.

Defined cases: a null, empty or malformed url has no words and gets the prior's verdict; a rule's verdict holds whatever the
score; rows that repeat a page are judged one by one; an empty table gives an empty table. Other columns play no part. All
counts are aggregates over all pages; frequent names are one row each before they are joined, and a host with a third of
the pages is a sum with partial aggregation.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorlens.llm.common import ascii_lower, ship
from donorlens.session import materialize

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block")]

#: Words of unwanted hosts: adult, gambling, pharmacy, advertising, spam.
SEEDS = ("adult ads advert bet bets betting bingo bonus cams casino cheap clickbait dating escort farm free gamble gambling "
         "jackpot lottery nude payday pharma pharmacy pills poker porn prize promo replica sex slots spam torrent track tracker "
         "tracking viagra warez webcam win winner xxx").split()
#: So many of them must meet a host's words.
SEEDS_MET = 1
MAX_WORD = 24


def split_url(url_col: str) -> tuple:
    """Columns host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    cut = F.instr(url, "://")
    rest = F.when(cut > 0, F.substr(url, cut + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(rules: list[tuple[str, str, str]]):
    """Struct of the rule (host and path as one text) and verdict of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _viterbi(batches):
    """Rows of a name, its substrings' starts, ends and counts, and the sum of all counts: its words."""
    for batch in batches:
        names = batch.column("name").to_pylist()
        out = []
        for i, name in enumerate(names):
            found = {(f["at"], f["len"]): f["n"] for f in batch.column("found")[i].as_py()}
            whole = math.log(batch.column("total")[i].as_py() + 1)
            best = [(0.0, 0)]
            for end in range(1, len(name) + 1):
                options = []
                for size in range(1, min(end, MAX_WORD) + 1):
                    n = found.get((end - size, size))
                    p = math.log(n) - whole if n else -whole - size * math.log(10)
                    options.append((best[end - size][0] + p, end - size))
                best.append(max(options))
            words, end = [], len(name)
            while end:
                start = best[end][1]
                words.append(name[start:end])
                end = start
            out.append(words[::-1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])


def names_in(text):
    """The names (runs of letters, lower-cased) of a text, with repeats."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: x != "")


def segment(names: DataFrame, corpus: DataFrame) -> DataFrame:
    """``names`` (name) to (name, words). ``corpus`` has the counted words (word, n)."""
    ship(names.sparkSession)
    corpus = corpus.where(F.length("word") <= MAX_WORD)
    total = corpus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    places = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("at"))
    places = places.select("name", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("at")))).alias("len"))
    places = places.withColumn("word", F.substr("name", F.col("at") + 1, F.col("len")))
    found = places.join(corpus, "word").groupBy("name").agg(F.collect_list(F.struct("at", "len", "n")).alias("found"))
    rows = names.join(found, "name", "left").join(F.broadcast(total), F.lit(True))
    rows = rows.select("name", F.coalesce("found", F.array().cast("array<struct<at:int,len:int,n:bigint>>")).alias("found"), "total")
    return rows.mapInArrow(_viterbi, "name string, words array<string>")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules: list[tuple[str, str, str]] = RULES, seeds: list[str] = SEEDS) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, host_words (array) and score (log odds of bad)."""
    host, path = split_url(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = materialize(rows, "url-rows")
    hosts = rows.groupBy("host").agg(F.count("*").alias("pages")).select("host", names_in(F.col("host")).alias("names"))
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("pages")).select("host", "path", "pages", names_in(F.col("path")).alias("names"))
    hosts, paths = materialize(hosts, "url-hosts"), materialize(paths, "url-paths")

    written = pages.select(F.explode(names_in(F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), r"<[^>]*>", " "))).alias("word"))
    named = hosts.select(F.explode("names").alias("word")).unionByName(paths.select(F.explode("names").alias("word")))
    listed = pages.sparkSession.createDataFrame([(x,) for x in seeds], "word string")
    corpus = written.unionByName(listed).groupBy("word").agg(F.count("*").alias("n"))
    names = materialize(segment(named.distinct().withColumnRenamed("word", "name"), corpus), "url-names")

    parts = lambda df, *keys: (df.select(*keys, F.posexplode("names").alias("pos", "name")).join(names, "name")
                               .select(*keys, "pos", "words"))
    seed_list = F.array(*[F.lit(x) for x in seeds]) if seeds else F.array().cast("array<string>")
    worded = parts(hosts, "host").groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "words"))), lambda x: x.words)).alias("words"))
    classed = hosts.select("host").join(worded, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    classed = materialize(classed.withColumn("bad", (F.size(F.array_intersect("words", seed_list)) >= SEEDS_MET).cast("long")), "url-classes")
    seen = classed.select("bad", F.explode("words").alias("word")).unionByName(
        parts(paths, "host").select("host", F.explode("words").alias("word")).join(classed.select("host", "bad"), "host").select("bad", "word"))
    odds = seen.groupBy("word").agg(F.sum("bad").alias("n_bad"), F.sum(1 - F.col("bad")).alias("n_good"))
    sums = odds.agg(F.sum("n_bad").alias("all_bad"), F.sum("n_good").alias("all_good"), F.count("*").alias("kinds"))
    log_odds = F.log((F.col("n_bad") + 1) / (F.col("all_bad") + F.col("kinds"))) - F.log((F.col("n_good") + 1) / (F.col("all_good") + F.col("kinds")))
    odds = materialize(odds.join(F.broadcast(sums), F.lit(True)).select("word", log_odds.alias("odds")), "url-odds")
    prior = classed.agg(F.log((F.sum("bad") + 1) / (F.sum(1 - F.col("bad")) + 1)).alias("prior"))

    by_name = names.select("name", F.explode("words").alias("word")).join(odds, "word").groupBy("name").agg(F.sum("odds").alias("odds"))
    score = lambda df, *keys: (df.select(*keys, F.explode("names").alias("name")).join(by_name, "name")
                               .groupBy(*keys).agg(F.sum("odds").alias(f"{keys[-1]}_odds")))
    urls = paths.select("host", "path").join(score(paths, "host", "path"), ["host", "path"], "left").join(score(hosts, "host"), "host", "left")
    urls = urls.join(F.broadcast(prior), F.lit(True)).join(classed.select("host", F.col("words").alias("host_words")), "host")
    urls = urls.withColumn("score", F.coalesce("prior", F.lit(0.0)) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)))
    urls = materialize(urls.select("host", "path", "host_words", F.round("score", 9).alias("score"), rule_of(rules).alias("by_rule")), "url-scores")
    out = rows.join(urls, ["host", "path"], "left")
    verdict = F.coalesce("by_rule.verdict", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("by_rule.rule").alias("rule"), verdict.alias("verdict"), "host_words", "score")
