"""Write the physical plan trees of the headline jobs to PLANS.md.

usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from textrec.operators import clean as C  # noqa: E402
from textrec.operators import collect as CO  # noqa: E402
from textrec.operators import evaluate as E  # noqa: E402
from textrec.operators import ingest as IN  # noqa: E402
from textrec.operators import model as M  # noqa: E402
from textrec.operators import score as S  # noqa: E402
from textrec.operators import split as SP  # noqa: E402
from textrec.plans import catalog as CAT  # noqa: E402
from textrec.plans.build import build_model  # noqa: E402
from textrec.session import get_spark  # noqa: E402
from textrec.sources import fixtures as FX  # noqa: E402


def tree(df) -> str:
    df.collect()   # final adaptive plan
    s = df._jdf.queryExecution().executedPlan().toString()
    s = s.split("+- == Initial Plan ==")[0]
    keep = []
    for line in s.split("\n"):
        line = line.rstrip()
        if "FileScan" in line:
            head = line[: line.index("FileScan")]
            parts = [line[line.index("FileScan"):].split(" Batched")[0]]
            for key in ("PartitionFilters: ", "PushedFilters: ", "ReadSchema: "):
                if key in line:
                    rest = line.split(key, 1)[1]
                    parts.append(key + rest.split(", PushedFilters")[0].split(", ReadSchema")[0][:160])
            line = head + " ".join(parts)
        elif len(line) > 200:
            line = line[:200] + " …"
        keep.append(line)
    return "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", "textrec-plans", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    m = build_model(spark, sf)
    songs = FX.songs(spark, sf).select("id", "name")
    flat = CO.flatten_status(FX.raw_statuses(spark, sf))
    text = FX.table(spark, sf, "benchmark").orderBy("item_id").first()["text"]
    jobs = [
        ("recommend_one (postings sorted by term)",
         "Query terms are broadcast; the postings scan has the text's own terms and w != 0 in "
         "`PushedFilters`, so row groups of other terms are skipped; partial sums before the (query, song) exchange; top-k is a "
         "TakeOrderedAndProject; the k result rows are broadcast for the name lookup.",
         S.recommend_one(text, m.postings, songs, 15, corpus_ids=m.corpus_ids)),
        ("recommend (batch of all held-out posts)",
         "Partial aggregation before the (query, song) exchange; `WindowGroupLimit … Partial` keeps at most k rows "
         "per query in each map task before the exchange on the query key.",
         S.recommend(C.test_rows(m.test_posts).select(E.query_key("id", "tweet_line").alias("query_id"),
                                                      F.col("tweet_line").alias("text")), m.postings, songs, 15)),
        ("clean_posts",
         "Dedupe and the per-song count are partial aggregates; the semi-join by song id is a broadcast or an "
         "AQE-split join, never a collected id list.",
         C.clean_posts(FX.posts(spark, sf))),
        ("corpus_terms + tfidf",
         "Lines are exploded and filtered with code-generated predicates (no lambda over arrays); (id, term) "
         "counts are partial aggregates; idf is a grouped count joined back on the term.",
         M.tfidf(M.corpus_terms(m.train_posts, m.train_verses))),
        ("split_exact (skew-safe positions)",
         "A range exchange on (song, hash) spreads a hot song over many partitions; local row numbers plus a "
         "small table of per-(partition, song) counts give exact positions.",
         SP.split_exact(m.posts_clean, 0.1)),
        ("select_posts (newest N per search)",
         "`WindowGroupLimit … Partial` before the exchange on the song: at most N rows per song per map task.",
         CO.select_posts(flat, CAT.END_DATE, "en", CAT.POSTS_PER_SEARCH)),
        ("attach_posts (K4)",
         "The least order per tweet_id is a hash aggregate over one decimal; whole rows only meet it in a semi-join, then an anti-join with stored ids.",
         IN.attach_posts(flat, FX.attach_songs(spark, sf), FX.existing_post_ids(spark, sf))),
    ]
    out = ["# Physical plans of the headline jobs", "",
           f"Generated by `python tools/explain_plans.py` at `{sf}` on `local[8]` (final adaptive plans).", ""]
    for title, note, df in jobs:
        out += [f"## {title}", "", note, "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
