"""Small corpora for the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int"
WORDS = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def texts(seed=0, n=40):
    """Plain documents, exact and near copies, a long one, NULL, empty and blank ones."""
    rng = random.Random(seed)
    out = ["\n".join(sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    out += [out[0], out[0], out[1] + " tail", out[2].replace("a", "b", 1), None, "", "  \n\t", "one two", "one two"]
    out.append(" ".join(sentence(rng, 50) for _ in range(120)))
    out.append(out[3] + "\n" + out[4] + "\n" + out[3])
    return out


def documents(spark, seed=0, n=40):
    """The texts as a table with extra columns whose names clash with inner ones, one row repeated, one without id."""
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "big", i) for i, t in enumerate(texts(seed, n))]
    rows += [rows[5], (None, "no id here at all", "en", "s1", 17, "x", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
