import random

from quartzflow.llm import pii

def shapes(text, kind):
    return [text[c[1] : c[2]] for c in pii.candidates(text) if c[0] == kind]


def seeds(text):
    return {text[c[1] : c[2]]: c[5] for c in pii.candidates(text) if c[5]}


def test_shapes_of_mail():
    for s in ["ann.lee+x@mail.example.org", "Ann_1 (at) site (dot) test", "a-b at site dot co dot test", "x[at]y-2 [dot] invalid", "3@example.net", "q <klammeraffe> site <tupfen> test"]:
        assert shapes(f"write to {s}, please", "email") == [s]
    for s in ["route kelp@BRX", "@handle", "offer at 1.5 dot", "name*anchor.example", "look at site.test", "@@@@", "a@a@a@", "(at)(at)(at)", " at " * 50 + " dot "]:
        assert shapes(s, "email") == []
    assert seeds("a@b.example, c (at) d (dot) example") == {"a@b.example": "email"}


def test_shapes_of_numbers():
    for s in ["+44 (0)20 7946 0068", "0044 7700 900 030", "(313) 555 0100", "313.555.0100", "1-554-555-0113", "QQ 47 16 62 D", "QQ931317C", "123-45-6789", "00004083D", "00.003.327-V"]:
        assert shapes(f"call {s}, ext. 12 now", "number") == [s]
    assert seeds("+12585550167; QQ 47 16 62 D; 123-45-6789; 313.555.0100") == {"+12585550167": "phone", "QQ 47 16 62 D": "id_number", "123-45-6789": "id_number"}
    assert shapes("at 2024-05-19, lot 3-79-52428335x", "number") == []


def test_shapes_of_street_addresses():
    for s in ["Flat 7, 881 Quarry Hatch Rd, Saltwick QX6 2ZZ", "460 Grey Heron Crescent", "1 Elm St, Apt 4B, Two Rivers, ZZ 00465", "Lindenweg 97a, 00670 Oststadt", "Calle Almendro Gris 1, 3º A, 00290 Puente Lares", "C/ Fuente Honda 141", "Am Krummbach 31b", "9 Grey Heron Wynd"]:
        assert s in shapes(f"lives at {s}. Next", "address")


def test_words_are_never_cut_from_patterns():
    long = "x" * 100
    assert pii.patterns(f"{long} call 5", len(long) + 6, len(long) + 7)[0] == f"l {long} call"


def corpus(rng):
    given = ["Maria", "Thomas", "Peter", "Julia", "Zoltan", "Ebba", "Kwame"]
    family = ["Averick", "Bolund", "Castrel", "Dorvane", "Estmar", "Farrow"]
    frames = ["Approved by {}, at noon.", "The holder, {}, asked for a call.", "When did {} open the account?", "signed: {}, all fine"]
    noise = ["Night Desk asks for a rerun.", "Silver Kelp and North Bridge are pools.", "The Pool Watch report is late.", "what Night Desk had expected"]
    docs, truth = [], []
    for k in range(400):
        n = f"{rng.choice(given)} {rng.choice(family)}"
        if k % 9 == 0:
            n = f"{n[0]}. {n.split()[1]}"
        docs.append((k, f"{rng.choice(noise)} {rng.choice(frames).format(n)} {rng.choice(noise)}"))
        truth.append((k, n))
    return docs, truth


def test_names_beyond_the_seeds_are_found_by_patterns(spark):
    docs, truth = corpus(random.Random(1))
    assert not {"ZOLTAN", "JULIA", "PETER"} & pii.SEED_NAMES
    df = spark.createDataFrame(docs + [(900, None), (901, ""), (902, "x " * 200_000)], "doc_id bigint, text string").selectExpr("*", "1 as doc", "2 as pii_type", "3 as n_found")
    got = {(r["doc_id"], r["pii_text"]) for r in pii.personal_information(df, "doc_id", "text").collect() if r["pii_type"] == "name"}
    assert len(got & set(truth)) >= 0.98 * len(truth) and len(got - set(truth)) <= 0.02 * len(truth)


FRAMES = {
    "address": ["the owner lives at {} since May", "post goes to {} for now", "moved to {} last week"],
    "email": ["write to {} for copies", "reachable under {} all day", "sent from {} today"],
    "phone": ["call {} before noon", "rings at {} all day", "fax to {} please"],
}
KNOWN = {"address": "{} Elder Street", "email": "ann{}@site.example", "phone": "+4470000{:05}"}
HELD_OUT = {"address": "{} Elder Wynd", "email": "bob{} <affe> site <tupf> example", "phone": "555/{:05}"}


def test_forms_that_are_no_seeds_are_found_by_patterns(spark):
    """Each held-out form has no seed; only the frames it shares with the seeds can tell."""
    rng = random.Random(3)
    docs, truth = [], set()
    for k in range(900):
        t = ("address", "email", "phone")[k % 3]
        form = (HELD_OUT if k % 4 == 0 else KNOWN)[t].format(100 + k)
        docs.append((k, f"Note. {rng.choice(FRAMES[t]).format(form)}. Pool 12 Grey Kelp Mint and (rerun) 555-77{k:04} went on."))
        if k % 4 == 0:
            truth.add((k, t, form))
    got = {tuple(r) for r in pii.personal_information(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text").collect()}
    assert len(truth & got) >= 0.98 * len(truth), {x[1] for x in truth - got}
    assert len(got) == 900


def test_placeholders_keep_the_rest(spark):
    docs = [(1, "Mail a@b.example or +12585550167."), (2, None), (3, ""), (4, "Nothing here."), (4, "Nothing here.")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["text"], r["n_found"]) for r in pii.redacted(df, "doc_id", "text").collect()), key=str)
    assert got == [(1, "Mail [EMAIL] or [PHONE].", 2), (2, None, 0), (3, "", 0), (4, "Nothing here.", 0), (4, "Nothing here.", 0)]
    assert pii.personal_information(df.limit(0), "doc_id", "text").count() == 0
