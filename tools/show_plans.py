"""Print the physical plan trees of the prepare job's stages (static plans,
AQE off, so every exchange is visible).  usage: python tools/show_plans.py [sf_dir]"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df):
    txt = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line[:160] for line in txt.splitlines())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from corpusmill.config import MixSpec, TrainSpec
    from corpusmill.operators.batches import epoch_plan, length_grouped
    from corpusmill.operators.tokens import tokenize_truncate
    from corpusmill.plans import catalog
    from corpusmill.plans.jobs import train_rows_from_corpus
    from corpusmill.plans.prepare import prepare
    from corpusmill.session import StageStore, local_session
    import corpusmill.session as SS

    spark = local_session(8)
    shown = {}
    orig = SS.StageStore.put

    def put(self, name, df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        shown[name] = tree(df)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        return orig(self, name, df)

    SS.StageStore.put = put
    specs = catalog.docs_capped(sf, cap=40)
    p = prepare(spark, specs, MixSpec(), store=StageStore(spark))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    shown["corpus"] = tree(p.corpus)
    tok = tokenize_truncate(train_rows_from_corpus(p.corpus), TrainSpec())
    shown["batches"] = tree(length_grouped(epoch_plan(tok, 1000, TrainSpec(), carry=["n_tokens"]), TrainSpec()))
    for k, v in shown.items():
        print(f"===== {k}\n{v}\n")


if __name__ == "__main__":
    main()
