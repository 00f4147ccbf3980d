import json

from pyspark.sql import functions as F

from portpulse.operators import location

LOCATION = (
    "evse_id string, evse_port_id string, cpo_name string, address string, suburb string, "
    "postcode int, lga_name string, state string, latitude double, longitude double, power double"
)
FUNDED = (
    "cpo_name string, address string, suburb string, postcode string, lga_name string, "
    "state string, latitude double, longitude double, program string, round int"
)


def place(port, lat, address="1 High St", lga="Town", postcode=2000, suburb="S", cpo="A"):
    return ("E" + port, port, cpo, address, suburb, postcode, lga, None, lat, 150.0, 7.0)


def test_states_of_postcodes(spark):
    expected = {
        2000: "NSW", 2599: "NSW", 2600: "ACT", 2618: "ACT", 2619: "NSW", 2899: "NSW",
        2900: "ACT", 2920: "ACT", 2921: "NSW", 2999: "NSW", 3000: "VIC", 3996: "VIC",
        3997: None, 4999: "QLD", 5799: "SA", 5800: None, 6797: "WA", 6798: None,
        7799: "TAS", 800: "NT", 899: "NT", 900: None,
    }
    df = spark.createDataFrame([(p,) for p in expected], "postcode int")
    rows = df.select("postcode", location.state_of_postcode(F.col("postcode")).alias("s")).collect()
    assert {r.postcode: r.s for r in rows} == expected


def test_cleaning_rules(spark):
    df = spark.createDataFrame(
        [("Wevolt", "a - b - c"), ("Other", "a - b"), (None, "a - b")], "cpo_name string, evse_id string"
    )
    rows = location.apply_cpo_cleaning(df).collect()
    assert sorted((r.cpo_name, r.evse_id) for r in rows) == [("Other", "a - b"), ("Wevolt", "a")]


def test_funded_match_takes_the_two_nearest_with_a_shared_word(spark):
    ports = spark.createDataFrame(
        [
            place("near", -33.001),
            place("second", -33.002, address="9 Low Rd", lga="Elsewhere"),
            place("third", -33.003),
            place("othersuburb", -33.0, suburb="S "),
        ],
        LOCATION,
    )
    funded = spark.createDataFrame(
        [
            ("A", "5 HIGH street", "S", "2000", "Shire", "NSW", -33.0, 150.0, "Grant", 2),
            ("A", "9 Far Av", "S", "2000", "Shire", "NSW", -30.0, 150.0, "Grant", 1),
        ],
        FUNDED,
    )
    matched = location.match_funded_sites(location.with_postcode_state(ports), funded)
    labels = {r.evse_port_id: r.government_funded for r in matched.collect()}
    assert labels == {
        "near": "Grant 2",
        "second": "not_funded",
        "third": "not_funded",
        "othersuburb": "not_funded",
    }
    trimmed = location.match_funded_sites(location.with_postcode_state(ports), funded, trim_keys=True)
    labels = {r.evse_port_id: r.government_funded for r in trimmed.collect()}
    assert labels["othersuburb"] == "Grant 2"


def test_crowded_match_group(spark):
    rows = [place(f"p{i:04d}", -33.0 - ((i * 37) % 1000) / 1000) for i in range(1000)]
    funded = spark.createDataFrame(
        [("A", "High", "S", "2000", "Town", "NSW", -33.5, 150.0, "Grant", 1)], FUNDED
    )
    ports = location.with_postcode_state(spark.createDataFrame(rows, LOCATION))
    got = location.match_funded_sites(ports, funded).where("government_funded <> 'not_funded'")
    nearest = sorted(rows, key=lambda r: (abs(r[8] + 33.5), r[0]))[:2]
    assert sorted(r.evse_port_id for r in got.collect()) == sorted(r[1] for r in nearest)


def component(long, short, *types):
    return {"long_name": long, "short_name": short, "types": list(types)}


def test_geocode_parts_and_filling(spark):
    level2 = component("Big Area", "BA", "administrative_area_level_2", "political")
    level1 = component("New South Wales", "NSW", "administrative_area_level_1")
    act = component("Dickson", "Dickson", "locality")
    responses = [
        (1.0, {"results": [
            {"formatted_address": "First", "address_components": [act, level1]},
            {"formatted_address": "Second", "address_components": [level2]},
        ]}),
        (2.0, {"results": [{"formatted_address": "Only", "address_components": [act]}]}),
        (3.0, {"results": []}),
    ]
    df = spark.createDataFrame(
        [(lat, 5.0, json.dumps(r)) for lat, r in responses],
        "latitude double, longitude double, response string",
    )
    parts = location.geocode_parts(df)
    got = {r.latitude: (r.geo_lga, r.geo_state, r.geo_address) for r in parts.collect()}
    assert got == {
        1.0: ("Big Area", "NSW", "First"),
        2.0: ("Unincorporated ACT", None, "Only"),
        3.0: (None, None, None),
    }
    gaps = spark.createDataFrame(
        [("a", 1.0, 5.0, None, None, "VIC"), ("b", 1.0, 5.0, "Kept", "Here", "NSW"),
         ("c", 2.0, 5.0, None, None, None), ("d", 9.0, 5.0, None, "There", None)],
        "id string, latitude double, longitude double, lga_name string, address string, state string",
    )
    lookup = spark.createDataFrame([("Big Area", "Area of Big")], "google_lga_name string, lga_name string")
    rows = location.fill_missing(gaps, parts, lookup).collect()
    assert {r.id: (r.lga_name, r.address, r.state) for r in rows} == {
        "a": ("Area of Big", "First", "NSW"),
        "b": ("Kept", "Here", "NSW"),
        "c": (None, "Only", None),
        "d": (None, "There", None),
    }
