"""Fixed values of the mountaineering configuration.

Every value below is data that results depend on: word lists, lookup tables, patterns, file
layouts and defaults. They are fixed values, kept together and in their natural order.
"""

# ---- Fixed values: name normalisation -------------------------------------------------------
SUBSTITUTIONS = [
    (r"(?<=\W)KANG", "KHANG"),
    (r"(?<=\W)SE(?=\W|\z)", "SOUTH EAST"),
    (r"(?<=\W)NE(?=\W|\z)", "NORTH EAST"),
]
TITLE_WORDS = ["NORTH", "WEST", "EAST", "SOUTH", "CENTRAL", "MIDDLE",
               "I", "II", "III", "IV", "V", "VI", "VII"]
IGNORE_WORDS = ["HIMAL", "PEAK"]
ROMAN_NUMERALS = ["I", "II", "III", "IV", "V", "VI", "VII"]
SLUG_PATTERN = "([^A-Z]+)|HIMAL|SUBSECTION"

# ---- Fixed values: linkage ------------------------------------------------------------------
CANDIDATE_COSINE = 0.5
MAIN_NAME_SIMILARITY = 0.85
LINK_THRESHOLD = 0.6
FIRST_SOURCE_THRESHOLD = 0.9
SECOND_SOURCE_THRESHOLD = 0.7
SECOND_SOURCE_OVERRIDES = {"RANI": "119", "LNKE": "233", "KABD": "143", "URKM": "400",
                           "KGUR": "154"}
REGION_OVERRIDES = {
    "GAMA": "DHAULAGIRI", "MATA": "KANJIROBA", "GHYM": "KANJIROBA", "JUNC": "DHAULAGIRI",
    "KTSU": "KANJIROBA", "MACH": "ANNAPURNA", "MING": "KHUMBU", "OMBK": "JANAK",
    "POIN": "KHUMBU", "SNOW": "DHAULAGIRI", "SRKU": "KANJIROBA", "GAUG": "DAMODAR",
    "PK41": "KHUMBU", "DZAS": "KHUMBU", "MYAG": "DHAULAGIRI", "ROMA": "SAIPAL",
    "TAWA": "DAMODAR", "GOJN": "KANTI", "LUNW": "ROLWALING", "LUN2": "ROLWALING",
    "DHEC": "DAMODAR", "GDNG": "CHANGLA", "PAWR": "PERI", "NGOR": "PERI",
    "FUTI": "DAMODAR", "SANK": "DAMODAR",
}
FIRST_SOURCE_CITATION = "OSM"
SECOND_SOURCE_CITATION = "MoTCA"

# ---- Fixed values: map elements -------------------------------------------------------------
NAME_TAGS = ["name", "int_name", "name:en", "alt_name", "alt_name:en"]
MAP_WINDOW = {"south": 27.0, "west": 81.0, "north": 30.0, "east": 89.0}
REGION_TAG = ("region:type", "mountain_area")
REGION_NAME_MATCHES = "subsection|himal"
REGION_NAME_EXCLUDES = "jugal.*and.*langtang"
PEAK_TAG = ("natural", "peak")
SIMPLIFY_TOLERANCE = 0.005
PARENT_OVERLAP = 0.99

# ---- Fixed values: duplicate resolution (table: key columns, compare column) ----------------
DUPLICATE_KEYS = {
    "hdb_expedition": (["expid"], "year"),
    "hdb_member": (["expid", "membid"], "myear"),
    "hdb_reference": (["expid", "refid"], "ryear"),
    "hdb_peak": (["peakid"], "peakid"),
}

# ---- Fixed values: model features -----------------------------------------------------------
FEATURES = {
    "expedition_year": {"column": "expedition_year"},
    "season": {"type": "categorical", "column": "season",
               "values": ["Spring", "Summer", "Winter"]},
    "commercial_route": {"type": "indicator", "column": "commercial_route", "value": "Y"},
    "total_members": {"column": "total_members"},
    "total_hired": {"column": "total_hired"},
    "age": {"column": "age"},
    "female": {"type": "indicator", "column": "sex", "value": "F"},
    "o2_used": {"type": "indicator", "column": "o2_used", "value": "Y"},
    "height": {"column": "height"},
    "himal": {"type": "categorical", "column": "himal", "values": [
        "ANNAPURNA", "BARUN", "CHANGLA", "DAMODAR", "DHAULAGIRI", "DOLPO", "GANESH", "GAUTAM",
        "GORAKH", "JANAK", "JUGAL", "KANJIROBA", "KANTI", "KUMBHAKARNA", "KUTANG", "LANGTANG",
        "MAKALU", "MANASLU", "MUSTANG", "NALAKANKAR", "NORTHERN", "PALCHUNGHAMGA", "PAMARI",
        "PERI", "ROLWALING", "SAIPAL", "SERANG", "SINGALILA", "UMBAK", "WESTERNSIKKIM",
        "YOKAPAHAR"]},
}
REQUEST_DEFAULTS = {
    "expedition_year": ("int", 2020),
    "season": ("string", "Autumn"),
    "commercial_route": ("string", "N"),
    "total_members": ("int", 5),
    "total_hired": ("int", 3),
    "age": ("int", 37),
    "sex": ("string", "M"),
    "o2_used": ("string", "N"),
}
FIRST_MODEL_YEAR = 1970
FOREST_TREES = 90
FOREST_DEPTH = 5
GRID_TREES = [50, 60, 70, 80, 90, 100, 110, 120]
GRID_DEPTHS = [None, 5, 10, 15]

# ---- Fixed values: colour ramp (hue, saturation, lightness at the low and the high end) ------
RAMP_LOW = (60, 100, 70)
RAMP_HIGH = (145, 100, 20)
RAMP_INVALID = "hsl(0 0% 100%)"

# ---- Fixed values: table layouts (flags are stored as 0/1 and therefore typed INT) -----------
CODE_TABLES = {
    "hdb_deathclass": "deathclass INT, deathclassdesc STRING",
    "hdb_deathtype": "deathtype INT, deathtypedesc STRING",
    "hdb_himal": "himal INT, himalname STRING",
    "hdb_injurytype": "injurytype INT, injurytypedesc STRING",
    "hdb_msmtbid": "msmtbid INT, msmtbiddesc STRING",
    "hdb_msmtnote": "msmtnote INT, msmtnotedesc STRING",
    "hdb_msmtterm": "msmtterm INT, msmttermdesc STRING",
    "hdb_season": "season INT, seasonname STRING, startday INT",
    "hdb_termreason": "termreason INT, termreasondesc STRING",
}
DIMENSION_TABLES = {
    "ref_peak": """peak_id STRING, peak_name STRING, alt_names STRING, location STRING,
        height INT, approximate_coordinates STRING, longitude DOUBLE, latitude DOUBLE,
        dms_longitude STRING, dms_latitude STRING, coordinate_notes STRING, himal STRING""",
}
FACT_TABLES = {
    "hdb_expedition": """expid STRING, peakid STRING, year INT, season INT, host INT,
        route1 STRING, route2 STRING, route3 STRING, route4 STRING, nation STRING,
        leaders STRING, sponsor STRING, success1 INT, success2 INT, success3 INT, success4 INT,
        ascent1 STRING, ascent2 STRING, ascent3 STRING, ascent4 STRING, claimed INT,
        disputed INT, countries STRING, approach STRING, bcdate STRING, smtdate STRING,
        smttime STRING, smtdays INT, totdays INT, termdate STRING, termreason INT,
        termnote STRING, highpoint INT, traverse INT, ski INT, parapente INT, camps INT,
        rope INT, totmembers INT, smtmembers INT, mdeaths INT, tothired INT, smthired INT,
        hdeaths INT, nohired INT, o2used INT, o2none INT, o2climb INT, o2descent INT,
        o2sleep INT, o2medical INT, o2taken INT, o2unkwn INT, othersmts STRING,
        campsites STRING, routememo STRING, accidents STRING, achievment STRING, agency STRING,
        comrte INT, stdrte INT, primrte INT, primmem INT, primref INT, primid STRING,
        chksum INT""",
    "hdb_member": """expid STRING, membid STRING, peakid STRING, myear INT, mseason INT,
        fname STRING, lname STRING, sex STRING, age INT, birthdate STRING, yob STRING,
        calcage INT, citizen STRING, status STRING, residence STRING, occupation STRING,
        leader INT, deputy INT, bconly INT, nottobc INT, support INT, disabled INT, hired INT,
        sherpa INT, tibetan INT, msuccess INT, mclaimed INT, mdisputed INT, msolo INT,
        mtraverse INT, mski INT, mparapente INT, mspeed INT, mhighpt INT, mperhighpt INT,
        msmtdate1 STRING, msmtdate2 STRING, msmtdate3 STRING, msmttime1 STRING,
        msmttime2 STRING, msmttime3 STRING, mroute1 INT, mroute2 INT, mroute3 INT,
        mascent1 INT, mascent2 INT, mascent3 INT, mo2used INT, mo2none INT, mo2climb INT,
        mo2descent INT, mo2sleep INT, mo2medical INT, mo2note STRING, death INT,
        deathdate STRING, deathtime STRING, deathtype INT, deathhgtm INT, deathclass INT,
        ams INT, weather INT, injury INT, injurydate STRING, injurytime STRING,
        injurytype INT, injuryhgtm INT, deathnote STRING, membermemo STRING, necrology STRING,
        msmtbid INT, msmtterm INT, hcn INT, mchksum INT, msmtnote1 INT, msmtnote2 INT,
        msmtnote3 INT, deathrte INT""",
    "hdb_reference": """expid STRING, refid STRING, ryear STRING, rtype INT, rjrnl STRING,
        rauthor STRING, rtitle STRING, rpublisher STRING, rpubdate STRING, rlanguage STRING,
        rcitation STRING, ryak94 STRING, rnotes STRING""",
    "hdb_peak": """peakid STRING, pkname STRING, pkname2 STRING, location STRING, heightm INT,
        heightf INT, himal INT, region INT, open INT, unlisted INT, trekking INT,
        trekyear STRING, restrict STRING, phost INT, pstatus INT, peakmemo STRING,
        pyear STRING, pseason INT, pexpid STRING, psmtdate STRING, pcountry STRING,
        psummiters STRING, psmtnote STRING, refermemo STRING, photomemo STRING""",
}
TABLE_KEYS = {
    "hdb_expedition": ["expid"], "hdb_member": ["expid", "membid"],
    "hdb_reference": ["expid", "refid"], "hdb_peak": ["peakid"], "ref_peak": ["peak_id"],
    "hdb_deathclass": ["deathclass"], "hdb_deathtype": ["deathtype"], "hdb_himal": ["himal"],
    "hdb_injurytype": ["injurytype"], "hdb_msmtbid": ["msmtbid"], "hdb_msmtnote": ["msmtnote"],
    "hdb_msmtterm": ["msmtterm"], "hdb_season": ["season"], "hdb_termreason": ["termreason"],
}
