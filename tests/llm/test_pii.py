"""Surrogates: nothing else changes, all mentions change, distinctness, coreference, format, gender and script."""

import ipaddress
import re

from pyspark.sql import functions as F

from curata.llm import pii as P

TEXTS = [
    "Write to ann.lee92@mail4.example.com or ANN.LEE92@MAIL4.EXAMPLE.COM!! today.",
    "Call +1 (651) 555-8500, 651-555-8500 or +1 (652) 555-8500. Not 12-34.",
    "Card 4111111111111111 and 4111 1111 1111 1111, bad 4111111111111112; id 0997523947200283",
    "Hosts 10.0.0.7, 192.168.1.20, 83.229.25.121. Version 1.2.3 and 1.2.3.4.5 stay; 300.1.1.1 too.",
    'x token = "592e2677e7e6567f917b8bfcceb4e5730d6fd3bc" y API_KEY: \'Ab12-xyz_9\' z TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"',
    "Mr John Smith met Mrs. Anna Smith; Mr Smith left. Frau Müller and г-жа Анна Иванова saw κ. Νίκος Παππάς.",
    "SSN 123-45-6789 here.",
    "No data at all, 12 words and 3.5 percent.", "", None, "Smith and John without a title", "a@b", "x" * 100000 + " ann.lee92@mail4.example.com",
]


CLASH = ["kind", "row", "mentions", "_mentions", "digest", "_digest", "news", "new", "canonical", "a.b c"]


def run(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in CLASH])
    out = P.replace(docs, counts="n", **more)
    assert out.columns == ["doc_id", "text", *CLASH, "n"]
    got = out.collect()
    assert len(got) == len(rows) and all(r[c] == c for r in got for c in CLASH)
    assert len({r.text for r in got if r.doc_id in (0, None)}) == 1
    return {r.doc_id: (r.text, r.n) for r in got if r.doc_id is not None}


def luhn(number):
    d = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d)) % 10 == 0


def test_surrogates(spark):
    got = run(spark, TEXTS)
    assert [got[i][1] for i in range(len(TEXTS))] == [2, 3, 4, 3, 3, 6, 1, 0, 0, 0, 0, 0, 1]
    for i in (7, 8, 9, 10, 11):
        assert got[i][0] == TEXTS[i]
    m = re.fullmatch(r"Write to ([a-z]+\.[a-z]+\d\d@[a-z]+\d\.[a-z]+\.com) or (\S+)!! today\.", got[0][0])
    assert m and m[2] == m[1].upper() and "lee" not in m[1] and got[12][0] == "x" * 100000 + " " + m[1]
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}), (\d{3})-(\d{3})-(\d{4}) or \+1 \((\d{3})\) (\d{3})-(\d{4})\. Not 12-34\.", got[1][0])
    assert m and m.groups()[:3] == m.groups()[3:6] != m.groups()[6:] and m[1] + m[2] + m[3] != "6515558500" and m[1][0] in "23456789"
    m = re.fullmatch(r"Card (4\d{15}) and (4\d{3} \d{4} \d{4} \d{4}), bad (4\d{15}); id (0\d{15})", got[2][0])
    assert m and m[2].replace(" ", "") == m[1] != "4111111111111111" and luhn(m[1]) and m[3] != m[1]
    m = re.fullmatch(r"Hosts (10\.\d+\.\d+\.\d+), (192\.168\.\d+\.\d+), (\d+\.\d+\.\d+\.\d+)\. Version 1\.2\.3 and 1\.2\.3\.4\.5 stay; 300\.1\.1\.1 too\.", got[3][0])
    assert m and m[3] != "83.229.25.121" and all(int(x) < 256 for x in m[3].split("."))
    m = re.fullmatch(r"x token = \"([0-9a-f]{40})\" y API_KEY: '([A-Z][a-z]\d\d-[a-z]{3}_\d)' z TOKEN = \"([0-9A-F]{40})\"", got[4][0])
    assert m and "592e" not in m[1][:4] and m[2] != "Ab12-xyz_9"
    m = re.fullmatch(r"Mr (\S+) (\S+) met Mrs\. (\S+) (\S+); Mr (\S+) left\. Frau (\S+) and г-жа (\S+) (\S+) saw κ\. (\S+) (\S+)\.", got[5][0])
    assert m and m[2] == m[4] == m[5] != "Smith" and m[6] not in (m[2], "Müller")
    assert m[1] in P.GIVEN["latin"]["m"].split() and m[3] in P.GIVEN["latin"]["f"].split()
    assert m[7] in P.GIVEN["cyrillic"]["f"].split() and re.fullmatch("[А-Яа-яё]+", m[8]) and m[9] in P.GIVEN["greek"]["m"].split()
    assert re.fullmatch(r"SSN 9\d\d-\d\d-\d{4} here\.", got[6][0])


MORE = {
    "fr": ("Appelez le {} ou le {} ou {} ou {}.", ["+33 6 12 34 56 78", "06 12 34 56 78", "0612345678", "06.12.34.56.78"]),
    "de": ("Tel. {} oder {}, {} und {}; {} nicht am 01.02.2023 10:30.", ["+49 30 1234567", "030/1234567", "+49 (0)30 1234567", "(030) 1234567", "0049 30 1234567"]),
    "es": ("Llame al {} hoy", ["+34 612 345 678"]),
    "en": ("Ring {} or {}; US {} and {}.", ["+44 20 7946 0958", "020 7946 0958", "6515558501", "651-555-8501"]),
    "secret": ("my password: {} and api_key={}&x=1, secret: nothing here", ["hunter22", "Zz9-abc_77"]),
    "name": ("Dr {} and Prof. Dr. {} met Frau Dr. {}.", ["Anna Smith", "Hans Weber", "Weber"]),
    "ip6": ("at {}, {} and {}; 12:30:45 std::vector", ["2001:db8::ff00:42:8329", "2001:DB8::FF00:42:8329", "fe80:0:0:0:202:b3ff:fe1e:8329"]),
}
PLAIN = ["On 01.02.2023 10:30, 01/02/2023 and 2023-01-02 0.123456789 of 012 parts, 1700000000 s, 12 0345, the secret: everything."]


def test_other_groupings_secrets_titles_and_ip6(spark):
    got = run(spark, [f.format(*x) for f, x in MORE.values()] + PLAIN)
    new = {}
    for i, (kind, (form, old)) in enumerate(MORE.items()):
        m = re.fullmatch(re.escape(form).replace(r"\{\}", "(.+?)"), got[i][0])
        assert m and got[i][1] == len(old), (kind, got[i])
        new[kind] = m.groups()
        assert all(a != b for a, b in zip(new[kind], old)), (kind, got[i])
        if kind in ("fr", "de", "es", "en", "ip6"):
            shape = lambda x: re.sub("[0-9a-fA-F]" if kind == "ip6" else r"\d", "9", x)
            assert [shape(x) for x in new[kind]] == [shape(x) for x in old]
    tail = lambda x, n: re.sub(r"\D", "", x)[-n:]
    assert len({tail(x, 9) for x in new["fr"]}) == len({tail(x, 9) for x in new["de"]}) == len({tail(x, 10) for x in new["en"][:2]}) == len({tail(x, 10) for x in new["en"][2:]}) == 1
    assert new["fr"][0].startswith("+33 ") and new["de"][2].startswith("+49 (0)") and new["ip6"][0] == new["ip6"][1].lower()
    assert new["name"][1].split()[1] == new["name"][2] and got[len(MORE)] == (PLAIN[0], 0)


def test_secrets_of_any_length(spark):
    long = ["ab1" * 3334, "Zz9-" * 2500, "a" * 400 + "7"]
    got = run(spark, [f'token = "{long[0]}" and password: {long[1]} then api_key={long[2]}&x=1', 'token = "abcdefghij'])
    m = re.fullmatch(r'token = "(\S+)" and password: (\S+) then api_key=(\S+)&x=1', got[0][0])
    assert got[0][1] == 3 and [len(x) for x in m.groups()] == [len(x) for x in long]
    for new, old in zip(m.groups(), long):
        assert sum(a != b for a, b in zip(new, old)) > len(old) / 2 and all(old[i:i + 40] not in new for i in range(0, len(old) - 40, 40))
    assert got[1] == ('token = "abcdefghij', 0)


def test_one_surrogate_per_given_name_whatever_the_title(spark):
    got = run(spark, ["Dr Anna Schmidt met Frau Anna Schmidt, Prof. Anna Schmidt and Mr Luca Rossi.", "Dr Luca Bianchi saw Sig. Luca Bianchi and M. Jean Dupont. Dr Kim Lee.",
                      "Mr Andrea Neri and Mrs Andrea Neri", "Frau Müller's dog, Mr O'Neil's cat, Mrs James' hat"])
    m = re.fullmatch(r"Dr (\S+) (\S+) met Frau (\S+) (\S+), Prof\. (\S+) (\S+) and Mr (\S+) (\S+)\.", got[0][0]).groups()
    assert m[0] == m[2] == m[4] and m[1] == m[3] == m[5] and m[0] in P.GIVEN["latin"]["f"].split() and m[6] in P.GIVEN["latin"]["m"].split()
    n = re.fullmatch(r"Dr (\S+) (\S+) saw Sig\. (\S+) (\S+) and M\. (\S+) (\S+)\. Dr (\S+) (\S+)\.", got[1][0]).groups()
    assert n[0] == n[2] == m[6] and n[1] == n[3] and n[4] in P.GIVEN["latin"]["m"].split() and len({n[0], n[4], n[6], m[0]}) == 4
    a = re.fullmatch(r"Mr (\S+) (\S+) and Mrs (\S+) (\S+)", got[2][0]).groups()
    assert a[0] in P.GIVEN["latin"]["m"].split() and a[2] in P.GIVEN["latin"]["f"].split() and a[1] == a[3]
    assert re.fullmatch(r"Frau (?!Müller)\p{L}+'s dog, Mr (?!O'Neil)\p{L}+'s cat, Mrs (?!James)\p{L}+' hat".replace(r"\p{L}", "[^\\W\\d_]"), got[3][0])


def test_one_surrogate_per_ip6_address_and_iban(spark):
    got = run(spark, ["at 2001:db8::1, 2001:0db8:0:0:0:0:0:1, 2001:0DB8::0001 and ::1:2a", "IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013000 or GB29NWBK60161331926819."])
    a, b, c, d = re.fullmatch(r"at (\S+), (\S+), (\S+) and (\S+)", got[0][0]).groups()
    full = lambda x: str(ipaddress.ip_address(x))
    assert got[0][1] == 4 and full(a) == full(b) == full(c) != full("2001:db8::1") and full(d) != full("::1:2a")
    assert re.fullmatch(r"[0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]", a) and re.fullmatch(r"[0-9a-f]{4}:0[0-9a-f]{3}:0:0:0:0:0:[0-9a-f]", b) and re.fullmatch(r"[0-9A-F]{4}:0[0-9A-F]{3}::000[0-9A-F]", c)
    x, y, z = re.fullmatch(r"IBAN (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) or (DE\d{20}) or (GB\d\d[A-Z]{4}\d{14})\.", got[1][0]).groups()
    assert x.replace(" ", "") == y != "DE89370400440532013000" and z != "GB29NWBK60161331926819" and "3704" not in x
    for iban in (y, z):
        assert int("".join(str(int(ch, 36)) for ch in iban[4:] + iban[:4])) % 97 == 1


def test_key_decides_and_reruns_agree(spark):
    a, b, c = run(spark, TEXTS), run(spark, TEXTS), run(spark, TEXTS, key="other")
    assert a == b and all(a[i][0] != c[i][0] for i in range(7))


def test_collisions_are_resolved(spark):
    """More given names and one-letter addresses than a first draw has room for stay distinct."""
    names = [f"Name{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    texts = ["; ".join(f"Mrs {n} Same" for n in names) + " " + " ".join(f"{chr(97 + i)}@d.org" for i in range(26)), *TEXTS[1:3]]
    got = run(spark, texts)[0][0]
    given = re.findall(r"Mrs (\S+) \S+", got)
    mails = re.findall(r"\S+@\S+", got)
    assert len(given) == len(set(given)) == 60 and len({x.split("@")[1] for x in mails}) == 1
    assert len(mails) == len(set(mails)) == 26 and not {x for x in mails} & {f"{chr(97 + i)}@d.org" for i in range(26)}


def test_empty(spark):
    assert P.replace(spark.createDataFrame([], "doc_id long, text string")).count() == 0
