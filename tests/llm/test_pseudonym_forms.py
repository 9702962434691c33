"""Pseudonyms by their contract: every shape, one to one, valid again, the same for one value in several spellings."""

import datetime
import ipaddress
import re

import pytest
from pyspark.sql import functions as F

from regwise.llm import pseudonyms


def _new(spark, texts, key="k"):
    rows = pseudonyms.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), key, kinds="kinds").collect()
    return {texts[r["i"]]: (r["text"], list(r["kinds"])) for r in rows}


def _shape(text):
    return re.sub("[0-9]", "0", text)


def test_phone_numbers_however_they_are_spaced(spark):
    for code, forms in (("1", ["+10175557713", "+1 (017) 555-7713", "+1.017.555.7713", "+1-017-555-7713", "+1 017 555 7713"]),
                        ("49", ["+491715551234", "+49 171 555 1234", "+49(171)555-1234"]), ("353", ["+353871234567", "+353 87 123 4567"]),
                        ("33", ["+33 1 42 68 53 00", "+33142685300", "+33 (1) 42.68.53.00"])):
        got = _new(spark, forms)
        assert all(kinds == ["phone"] for _, kinds in got.values())
        digits = {re.sub("[^0-9]", "", text) for text, _ in got.values()}
        assert len(digits) == 1 and digits.pop().startswith(code)
        assert all(_shape(new) == _shape(old) and new != old for old, (new, _) in got.items())
    national = _new(spark, ["(017) 555-7713", "(017)555-7713", "017-555-7713", "017.555.7713", "+10175557713"])
    assert len({re.sub("[^0-9]", "", t)[-10:] for t, _ in national.values()}) == 1 and all(_shape(a) == _shape(b) for a, (b, _) in national.items())


def test_numbers_that_are_no_phones_stay(spark):
    texts = ["+1 (000) 000-0000", "+1 017 555 771", "+999 12 34 56", "+210123456789", "+49 12", "1-017-555-7713-22", "017-555-77131", "555-7713", "+", "a+b 12"]
    assert all(new == old and not kinds for old, (new, kinds) in _new(spark, texts).items())


def _luhn(digits):
    return sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10


def test_cards_pass_their_checksum_again(spark):
    forms = ["378282246310005", "3782 822463 10005", "3782-822463-10005"]
    got = _new(spark, [*forms, "4417 7442 8035 1547", "378282246310006", "3782 822463 10006"])
    digits = {re.sub("[^0-9]", "", got[f][0]) for f in forms}
    assert len(digits) == 1 and _luhn(digits.pop()) == 0 and all(_shape(got[f][0]) == _shape(f) and got[f][1] == ["card"] for f in forms)
    assert got["378282246310006"] == ("378282246310006", []) and got["3782 822463 10006"] == ("3782 822463 10006", [])


def _mod_97(account):
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_accounts_pass_their_check_again(spark):
    forms = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"]
    others = ["GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "NO93 8601 1117 947"]
    got = _new(spark, [f"to {f}." for f in forms + others] + ["DE88 3704 0044 0532 0130 00"])
    new = {f: got[f"to {f}."][0][3:-1] for f in forms + others}
    assert all(_mod_97(v) == 1 and v[:2] == f[:2] and v != f and re.sub("[A-Z]", "A", _shape(v)) == re.sub("[A-Z]", "A", _shape(f)) for f, v in new.items())
    assert new[forms[0]].replace(" ", "") == new[forms[1]] and got["DE88 3704 0044 0532 0130 00"][1] == []


def test_addresses_of_both_versions(spark):
    same = ["2001:db8::ff00:42:8329", "2001:0db8:0000:0000:0000:ff00:0042:8329", "2001:DB8:0:0:0:FF00:42:8329"]
    other = ["fe80::1", "2001:db8::", "10.0.0.1"]
    got = _new(spark, [f"from {t} on" for t in same + other])
    new = {t: got[f"from {t} on"][0][5:-3] for t in same + other}
    assert len({ipaddress.ip_address(new[t]) for t in same}) == 1
    assert all(ipaddress.ip_address(new[t]).version == ipaddress.ip_address(t).version and ipaddress.ip_address(new[t]) != ipaddress.ip_address(t) for t in same + other)
    stay = ["at 12:30:45 and 08:15", "std::vector a::b", "1.2.3.400", "1:2:3:4:5:6:7:8:9", "::1"]
    assert all(new == old for old, (new, _) in _new(spark, stay).items())


def test_mail_in_other_scripts(spark):
    texts = ["jürgen@x.org", "ΩΜ@x.org", "иван.петров@почта.example", "田中@x.org", "a.b9@x.org"]
    for old, (new, kinds) in _new(spark, texts).items():
        local, domain = new.split("@")
        assert kinds == ["email"] and domain == old.split("@")[1] and len(local) == len(old.split("@")[0])
        assert sum(a == b for a, b in zip(local, old) if a.isalnum()) <= 1
        assert [c.isalnum() for c in local] == [c.isalnum() for c in old.split("@")[0]]
    assert all(new == old for old, (new, _) in _new(spark, ["._%@x.org", "a@b", "@x.org", "a@b.1"]).items())


SPELLINGS = {"iso": "yyyy-MM-dd", "dots": "dd.MM.yyyy", "short dots": "d.M.yyyy", "slashes": "MM/dd/yyyy", "short slashes": "M/d/yyyy", "late": "dd/MM/yyyy",
             "short late": "d/M/yyyy", "month": "MMMM d, yyyy", "brief month": "MMM d yyyy", "day month": "d MMMM yyyy"}
FORMS = {"yyyy": "%Y", "MMMM": "%B", "MMM": "%b", "MM": "%m", "M": "%m", "dd": "%d", "d": "%d"}


def _read(text, form):
    pattern = re.sub("y+|M+|d+", lambda m: FORMS[m[0]], form)
    if "%B" in pattern and re.search(r"\b[A-Z][a-z]{2}\b", text):  # May tells nothing of how long names are
        pattern = pattern.replace("%B", "%b")
    return datetime.datetime.strptime(text, pattern).date()


@pytest.mark.parametrize("name", SPELLINGS)
def test_different_days_never_share_a_pseudonym(spark, name):
    form = SPELLINGS[name]
    days = spark.range(73050).select(F.date_add(F.lit("1900-03-01").cast("date"), F.col("id").cast("int")).alias("day"))
    if "late" in name:  # the first number must tell that it is a day
        days = days.where(F.day("day") > 12)
    rows = pseudonyms.pseudonymise(days.select("day", F.date_format("day", form).alias("text")), "k", kinds="kinds").select("day", "text", "kinds").collect()
    assert all(r["kinds"] == ["date"] for r in rows)
    new = {r["day"]: _read(r["text"], form) for r in rows}
    assert len(set(new.values())) == len(rows) and sum(a == b for a, b in new.items()) < 20
    assert min(new.values()) >= datetime.date(1900, 3, 1) and max(new.values()) <= datetime.date(2100, 3, 1)


def test_slash_dates_of_both_orders_share_no_text(spark):
    days = spark.range(73050).select(F.date_add(F.lit("1900-03-01").cast("date"), F.col("id").cast("int")).alias("day"))
    both = days.select(F.date_format("day", "MM/dd/yyyy").alias("text")).union(days.where(F.day("day") > 12).select(F.date_format("day", "dd/MM/yyyy")))
    assert pseudonyms.pseudonymise(both, "k").distinct().count() == both.count()


def test_one_day_in_several_spellings(spark):
    forms = {"2020-02-01": "%Y-%m-%d", "01.02.2020": "%d.%m.%Y", "1.2.2020": "%d.%m.%Y", "02/01/2020": "%m/%d/%Y", "2/1/2020": "%m/%d/%Y", "February 1, 2020": "%B %d, %Y", "1 February 2020": "%d %B %Y"}
    got = _new(spark, list(forms))
    assert len({datetime.datetime.strptime(got[t][0], f) for t, f in forms.items()}) == 1
    text = "2020-01-01/2020-02-01 and 01/02/2020-03/04/2020"
    new, kinds = _new(spark, [text])[text]
    assert kinds == ["date"] * 4 and not set(re.findall("[0-9/]{8,}|[0-9-]{8,}", new)) & set(re.findall("[0-9/]{8,}|[0-9-]{8,}", text))
    stay = ["2021-02-30", "31.4.2020", "13/13/2020", "0/5/2020", "February 30, 2020", "1850-01-01", "2020-1", "12020-01-01", "1.2.2020.4"]
    assert all(new == old for old, (new, _) in _new(spark, stay).items())


def test_another_key_gives_other_pseudonyms(spark):
    texts = ["a.b9@x.org", "2020-02-01", "(017) 555-7713"]
    assert all(_new(spark, texts, "a")[t][0] != _new(spark, texts, "b")[t][0] for t in texts)
