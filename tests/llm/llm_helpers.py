from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def clash(df):
    """The frame with columns whose names the operators use themselves."""
    names = ["k1", "k2", "r1", "r2", "gone", "lang_pred", "score", "fp", "component", "n_removed", "t", "key", "uid"]
    return df.select("*", *[F.lit(7).alias(n) for n in names])
