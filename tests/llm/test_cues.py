"""Secrets and accounts behind quoted, compound and camel-case keys."""
import pytest


@pytest.mark.parametrize("text, kind, value", [
    ('{"password": "hunter2hunter2"}', "secret", "hunter2hunter2"),
    ("secret_key=abcd1234efgh", "secret", "abcd1234efgh"),
    ("'token' => 'abcd1234efgh'", "secret", "abcd1234efgh"),
    ('apiKey: "abcd1234efgh"', "secret", "abcd1234efgh"),
    ("İ É accessTokenValue = abcd1234efgh", "secret", "abcd1234efgh"),
    ('token = "abcd1234efgh"', "secret", "abcd1234efgh"),
    ("token" + " " * 50 + "=" + "\t" * 9 + "abcd1234efgh", "secret", "abcd1234efgh"),
    ("token_" + "of_the_service_" * 20 + "x: abcd1234efgh", "secret", "abcd1234efgh"),
    ("secretTokenPassword" * 5 + "Of" * 40 + " = abcd1234efgh", "secret", "abcd1234efgh"),
    ("IBAN" + " " * 30 + "is" + " " * 30 + "DE89370400440532013000", "account", "DE89370400440532013000"),
    ("My IBAN is DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"),
    ("iban number: DE89370400440532013000", "account", "DE89370400440532013000"),
    ('"iban": "DE89370400440532013000"', "account", "DE89370400440532013000"),
    ("IBAN DE89370400440532013000", "account", "DE89370400440532013000"),
])
def test_value_behind_the_key_is_found(text, kind, value):
    from oeeflow.llm.pii import find_spans
    assert [text[s:e] for k, s, e in find_spans(text) if k == kind] == [value]


def test_prose_has_no_secret():
    from oeeflow.llm.pii import find_spans
    assert find_spans("the tokens: understanding them; a secret understanding, iban number unknown") == []


def test_keys_of_many_cues_take_linear_time():
    import time

    from oeeflow.llm.pii import find_spans
    begun = time.perf_counter()
    assert find_spans("token_" * 200_000 + "Token" * 200_000) == []
    assert [k for k, _, _ in find_spans("password-" * 200_000 + "x = abcd1234efgh")] == ["secret"]
    assert time.perf_counter() - begun < 20
