"""Entropy windows by class, and candidates that base spans cover in part."""

import random

from quillstone.llm import secret_scan

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)


def test_hex_keys_behind_a_prefix_are_judged_as_hex(spark):
    rng = random.Random(11)
    keys = ["".join(rng.choices("0123456789ABCDEF", k=40)) for _ in range(60)]
    keys = [k for k in keys if not any(w in k.lower() for w in secret_scan.ALLOWED_WORDS)]
    for r in secret_scan.scan(frame(spark, [p + k + " end" for k in keys for p in ("", "sig=", "x-")])).collect():
        assert [tuple(s) for s in r.spans] == [(0, 3, len(r.text) - 4)], r.text


def test_digits_behind_a_prefix_are_no_hex_key(spark):
    texts = ["x-98765432109876543210 end"]
    assert all(s["kind"] != 3 for r in secret_scan.scan(frame(spark, texts)).collect() for s in r.spans)


def test_the_rest_of_a_secret_around_a_hex_run_goes(spark):
    inner = "9f86d081884c7d65"
    key = f"Zk3jQ9vL2xT8{inner}RW1cR7yH4bN5mQ"
    texts = [f"see {key} here", f"see {inner} here", "token=Zk3jQ9vL2xT8bN5mW1cR7yH4"]
    found = {r.doc_id: r.text for r in secret_scan.redact(frame(spark, texts)).collect()}
    assert found == {0: "see [SECRET] here", 1: "see [SECRET] here", 2: "[SECRET]"}


def harmless(rng):
    """Strings of 20 characters or more, with digits and letters, that are no secrets: paths, slugs, names, ids of files."""
    words = "report annual photo holiday backup final draft customer invoice module index bread sourdough project notes summary river mountain".split()
    w = lambda: rng.choice(words)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice(
        [
            lambda: f"{n(4)}/{n(2)}/{n(2)}/{w()}-{w()}-{w()}",
            lambda: f"/Users/{w().title()}{w().title()}/Documents/{w()}{n(4)}",
            lambda: f"the_{w()}_{w()}_{w()}_{n(1)}_{w()}",
            lambda: f"IMG_{n(8)}_{n(6)}_{w()}",
            lambda: f"{w().title()}{w().title()}{w().title()}Handler{n(2)}",
            lambda: f"{w()}-{n(1)}-{n(2)}-{n(1)}-{w()}-{w()}",
            lambda: f"src/{w()}/{w().title()}{n(2)}/{w()}_{w()}_v{n(1)}",
            lambda: f"{w().upper()}_{w().upper()}_{n(4)}_{w().upper()}",
        ]
    )()


def keys(rng):
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return "".join(rng.choices(*rng.choice([(alnum, None), (alnum + "+/", None), ("0123456789ABCDEF", None), (alnum + "_-", None)])[:1], k=rng.choice([32, 40, 44, 64])))


def test_recall_and_precision(spark):
    rng = random.Random(21)
    good = [k for k in (keys(rng) for _ in range(1500)) if any(c.isdigit() for c in k) and any(c.isalpha() for c in k)]
    bad = [x for x in (harmless(rng) for _ in range(1500)) if len(x) >= 20]
    found = [any(s["kind"] == 3 for s in r.spans) for r in secret_scan.scan(frame(spark, [f"see {x} there" for x in good + bad])).orderBy("doc_id").collect()]
    recall, alarms = sum(found[: len(good)]) / len(good), sum(found[len(good) :]) / len(bad)
    print("recall", recall, "false alarms", alarms)
    assert recall >= 0.99 and alarms <= 0.01
