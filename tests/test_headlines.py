import itertools
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lindero.functions import names as N
from lindero.operators import headlines, news


def extract(spark, people, titles):
    index = headlines.name_index(spark.createDataFrame([(p,) for p in people], "name string"), "name")
    rows = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    return [r.names for r in headlines.extracted_names(rows, "id", "title", index).orderBy("id").collect()]


def test_names_in_headlines(spark):
    people = ["Marta Solís", "Bruno Iván Robles", "Nadia Paz Roca"]
    titles = [
        "Marta Solís y Bruno Robles presentaron el proyecto de la Dra. Eva Luz", "N. Roca y la Dra. B. Robles presentaron un proyecto", "La doctora Nadia Roca Lima habló", "Sin nombres, aquí", None, "",
        "bruno iván robles; MARTA SOLIS", "Dr. Bruno Iván Robles, Dr. Bruno Iván Robles", "N Roca habló", "El Dr. Nadia Paz Roca ganó",
    ]
    got = extract(spark, people, titles)
    assert got == [["Marta Solís", "Bruno Robles"], ["N. Roca", "B. Robles"], ["Nadia Roca"], [], [], [], ["bruno iván robles", "MARTA SOLIS"], ["Bruno Iván Robles"], [], ["Nadia Paz Roca"]]


def test_too_many_names_for_initials(spark):
    assert extract(spark, [f"NORA{chr(65 + i)} VEGA" for i in range(26)], ["N. Vega habló"]) == [[]]
    assert extract(spark, [f"NORA{chr(65 + i)} VEGA" for i in range(25)], ["N. Vega habló"]) == [["N. Vega"]]


def brute(people, title):
    """The same by loops, without honorifics."""
    norm = lambda x: re.sub(r"[^A-Z0-9]+", " ", "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M").upper()).split()
    index = {tuple(norm(p)) for p in people}
    words = [(norm(m[0])[0], m.start(), m.end()) for m in re.finditer(r"[^\W_]+", title)]
    owners = {}
    for n in index:
        for later in set(n[1:]) if len(n) > 2 else ():
            owners.setdefault((n[0], later), set()).add(n)
    out, whole = {}, []

    def add(a, b):
        key = tuple(norm(title[a:b]))
        if key not in out or a < out[key][0]:
            out[key] = (a, b)

    for i in range(len(words)):
        for n in range(10, 1, -1):
            run = words[i : i + n]
            if len(run) == n and tuple(w for w, _, _ in run) in index:
                add(run[0][1], run[-1][2])
                whole.append((run[0][1], run[-1][2]))
                break
    for (a, s, _), (b, _, e) in itertools.pairwise(words):
        if len(owners.get((a, b), ())) == 1 and not any(s < y and x < e for x, y in whole):
            add(s, e)
    return [title[a:b] for a, b in sorted(out.values())]


def test_extraction_by_loops(spark):
    rng = random.Random(3)
    vocabulary = ["Ana", "Luz", "Paz", "Sol", "Mar", "Íñigo", "Roca", "Vega"]
    people = [" ".join(rng.sample(vocabulary, rng.randint(2, 4))) for _ in range(25)]
    titles = [" ".join(rng.choice([*vocabulary, "y", "habló,", "con"]) for _ in range(rng.randint(1, 9))) for _ in range(80)]
    assert extract(spark, people, titles) == [brute(people, t) for t in titles]


@pytest.mark.parametrize(
    "headline, names, want",
    [
        ("Imputan a un médico por la muerte de un bebé que era su paciente", [], ["ADVERSE_OR_JUDICIAL", "MINOR", "PRIVATE_HEALTH"]), ("El tribunal suspendió la audiencia", [], ["ADVERSE_OR_JUDICIAL"]),
        ("Un club ficticio presentó a su jugador", [], [news.NOT_BENIGN]), ("Premio nacional", [], [news.NOT_BENIGN]), ("La Dra. Eva Luz recibió un reconocimiento académico", ["Eva Luz"], []), ("La cardióloga Eva Luz recibió un premio", ["Eva Luz"], []),
        ("Eva Luz y Bruno Robles participaron en un congreso", ["Eva Luz", "Bruno Robles"], []), ("Eva Luz recibió un premio y contó que tiene diabetes", ["Eva Luz"], [news.NOT_BENIGN]), ("Eva Luz recibió un premio", [], [news.NOT_BENIGN]),
        ("Eva Luz recibió un premio", ["Eva Luz", "Otra Persona"], [news.NOT_BENIGN]),
    ],
)
def test_headlines_are_restricted_unless_benign(spark, headline, names, want):
    row = spark.createDataFrame([(headline, names)], "h string, n array<string>")
    assert row.select(news.headline_reasons(F.col("h"), F.col("n"))).first()[0] == want


def test_agreement_uses_the_same_relation(spark):
    index = headlines.name_index(spark.createDataFrame([("Ana Sol Paz",), ("Ana Paz",), ("Ada Mar Paz",)], "name string"), "name")
    runs = spark.createDataFrame([(1, ["A", "PAZ"]), (2, ["ANA", "PAZ"]), (3, ["A", "SOL", "PAZ"]), (4, ["B", "PAZ"])], "id int, run array<string>")
    assert {r.id: r.names for r in headlines._agreeing(runs, index, ["id"]).collect()} == {1: 3, 2: 2, 3: 1}
    assert N.EXACT
