"""Property test: Spark title_case == a plain-Python model of the INITCAP rule
(word starts take the Unicode title-case mapping, the rest is lower-cased)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from civicflow.functions import title_case

DELIMS = set(" \t\n\r\f\x0b!?@\"^#$&~_,.:;+-*%/|\\[](){}<>")


def model(s: str) -> str:
    out, start = [], True
    for ch in s.lower():
        if ch in DELIMS:
            out.append(ch)
            start = True
        else:
            out.append(ch.title() if start else ch)
            start = False
    return "".join(out)


ALPHABET = st.sampled_from(list("aBcXyZ019'éÖß") + sorted(DELIMS))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=200, max_size=200))
def test_title_case_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == [model(v) for v in values]
