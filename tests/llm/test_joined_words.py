"""Toxic words joined to others inside a chunk."""
from tests.llm.frames import documents


def test_terms_are_found_inside_joined_chunks(spark):
    from oeeflow.llm.toxicity import lexicon_matches
    terms = ["idiot", "stupid", "moron", "clown"]
    cases = [("ha you\tidiot", {(0, 0)}), ("a stupid-looking thing", {(1, 0)}), ("moron/clown", {(2, 0), (3, 0)}),
             ("idiot,you", {(0, 0)}), ("an idiot's view", {(0, 0)}), ("an idiot’s view", {(0, 0)}),
             ("so\rstupid moron", {(1, 0), (2, 0)}), ("stupit-looking", {(1, 1)}), ("id*ot", {(0, 1)}),
             ("id-iot", {(0, 1)}), ("well-known", set()), ("idiot", {(0, 0)}), ("", set())]
    docs = documents(spark, list(enumerate(t for t, _ in cases)))
    got = {r["id"]: set(zip(r["term"], r["distance"])) for r in lexicon_matches(docs, terms, "doc_id", "text").collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}
    weight = {r["id"]: r["weight"] for r in lexicon_matches(docs, terms, "doc_id", "text").collect()}
    assert weight[3] == [1.2] and weight[11] == [1.0]
