"""Codes of property records: use, materials, roofs, deeds, improvements and units, as first-match rules over texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import let
from .rules import first_match

#: Fixed values: (property type, texts of which one must occur, texts of which none may) of two counties' use descriptions.
BREVARD_USES = [
    ("VacantLand", ["VACANT RESIDENTIAL", "VACANT LAND"], []), ("SingleFamily", ["SINGLE FAMILY"], []), ("ManufacturedHousing", ["MANUFACTURED HOUSING"], []), ("MobileHome", ["MOBILE HOME"], []),
    ("Modular", ["MODULAR"], []), ("Townhouse", ["TOWNHOUSE"], []), ("Duplex", ["DUPLEX"], []), ("TwoToFourFamily", ["TRIPLEX", "QUADRUPLEX"], []),
    ("MultipleFamily", ["MULTIPLE LIVING UNITS - 5 TO 9", "GARDEN APARTMENTS", "LOW RISE APARTMENTS", "HIGH RISE APARTMENTS"], []), ("Condominium", ["CONDOMINIUM"], []), ("Cooperative", ["COOPERATIVE", "CO-OP"], []),
    ("Retirement", ["RETIREMENT HOME"], []), ("Timeshare", ["TIME SHARE"], []), ("MiscellaneousResidential", ["MISC RESIDENTIAL", "MIGRANT"], []), ("ResidentialCommonElementsAreas", ["COMMON AREA"], []),
]
LAKE_USES = [
    ("VacantLand", ["VACANT RESIDENTIAL"], []), ("SingleFamily", ["SINGLE FAMILY"], []), ("ManufacturedHousing", ["MANUFACTURED HOME SUB", "MANUFACTURED SUB"], []), ("MobileHome", ["MANUFACTURED HOME"], ["SUB"]),
    ("MultipleFamily", ["MULTI FAMILY >9", "MULTI FAMILY >=10"], []), ("TwoToFourFamily", ["MULTI FAMILY <5", "MULTI FAMILY >4 AND <10", "MULTI FAMILY <=9"], []), ("Condominium", ["CONDO"], []), ("Cooperative", ["CO-OP"], []),
    ("Retirement", ["RETIREMENT HOME"], []), ("MiscellaneousResidential", ["MISC RESIDENTIAL", "MIGRANT"], []), ("Timeshare", ["TIMESHARE"], []), ("Townhouse", ["TOWNHOUSE"], []), ("Duplex", ["DUPLEX"], []), ("Pud", ["PUD"], []),
    ("MobileHome", ["MOBILE HOME"], []), ("ResidentialCommonElementsAreas", ["COMMON ELEMENTS"], []),
]
#: Building parts and the texts that name them.
EXTERIORS = [("Stucco", ["STUCCO"], []), ("Brick", ["BRICK"], []), ("Natural Stone", ["STONE"], []), ("Vinyl Siding", ["VINYL"], []), ("Wood Siding", ["WOOD"], []), ("Fiber Cement Siding", ["FIBER", "HARDI"], []), ("Metal Siding", ["METAL"], []), ("Concrete Block", ["BLOCK"], [])]
FRAMES = [("Wood Frame", ["WOOD"], []), ("Steel Frame", ["STEEL"], []), ("Masonry", ["MASON", "MASN", "CONC", "BLOCK"], []), ("Poured Concrete", ["POURED"], [])]
ROOF_MATERIALS = [("Shingle", ["SHING"], []), ("Metal", ["METAL"], []), ("Tile", ["TILE", "CLAY", "CONC"], []), ("Stone", ["SLATE"], []), ("TPO Membrane", ["TPO"], []), ("EPDM Membrane", ["EPDM"], [])]
ROOF_DESIGNS = [("Combination", ["HIP&GABLE"], []), ("Hip", ["HIP"], []), ("Gable", ["GABLE"], []), ("Flat", ["FLAT"], []), ("Shed", ["SHED"], [])]
ROOF_COVERINGS = [
    ("3-Tab Asphalt Shingle", ["ASPH&SHNGL"], []), ("Architectural Asphalt Shingle", ["ARCH&SHING"], []), ("Metal Standing Seam", ["METAL"], []), ("TPO Membrane", ["TPO"], []), ("EPDM Membrane", ["EPDM"], []),
    ("Natural Slate", ["SLATE"], []), ("Clay Tile", ["TILE", "CLAY"], []), ("Concrete Tile", ["CONC"], []),
]
#: Fixed values: (improvement type, words of descriptions), in order.
IMPROVEMENTS = [
    ("LandscapeIrrigation", ["irrigation", "sprinkler", "landscape", "lawn"]), ("PoolSpaInstallation", ["pool", "spa", "jacuzzi", "hot tub"]), ("ScreenEnclosure", ["screen", "enclosure"]), ("ShutterAwning", ["shutter", "awning"]),
    ("Fencing", ["fence", "gate"]), ("DockAndShore", ["dock", "seawall", "pier", "boathouse", "bulkhead"]), ("Roofing", ["roof"]), ("Solar", ["solar", "photovoltaic"]), ("DrivewayPermit", ["driveway", "sidewalk", "paver", "paving", "culvert"]),
    ("ExteriorOpeningsAndFinishes", ["porch", "deck", "patio", "lanai", "balcony", "terrace", "gazebo", "pergola"]), ("MechanicalHVAC", ["hvac", "mechanical"]), ("Electrical", ["electrical"]), ("Plumbing", ["plumb"]),
    ("GasInstallation", ["gas"]), ("BuildingAddition", ["addition", "add-on"]), ("Demolition", ["demolition", r"\bdemo\b", "remove"]),
]
#: Deed types of numbered sale codes, in the order in which they count.
DEED_CODES = [
    ("11", "Contract for Deed"), ("14", "Special Warranty Deed"), ("12", "Quitclaim Deed"), ("06", "Quitclaim Deed"), ("07", "Sheriff's Deed"), ("08", "Trustee's Deed"), ("09", "Personal Representative Deed"),
    ("10", "Correction Deed"), ("15", "Personal Representative Deed"), ("16", "Trustee's Deed"), ("17", "Tax Deed"), ("18", "Sheriff's Deed"), ("19", "Administrator's Deed"), ("20", "Guardian's Deed"),
    ("13", "Warranty Deed"), ("05", "Warranty Deed"), ("04", "Warranty Deed"), ("03", "Warranty Deed"), ("02", "Warranty Deed"), ("01", "Warranty Deed"),
]
#: Fixed values: (deed type, alternatives): an alternative holds if all texts of its first tuple, and none of its second,
#: occur in the letters and digits of the stated type, in order.
DEED_LETTERS = [
    ("Special Warranty Deed", [(("SPECIAL", "WARRANTY"), ()), (("SWD",), ()), (("SPWD",), ()), (("SPECWARR",), ())]),
    ("Warranty Deed", [(("WD",), ()), (("WARRANTY",), ()), (("WAR", "DEED"), ("SPECIAL",))]),
    ("Quitclaim Deed", [(("QUIT",), ()), (("QCD",), ()), (("QC",), ())]),
    ("Grant Deed", [(("GRANT",), ()), (("GD",), ())]),
    ("Bargain and Sale Deed", [(("BARGAIN",), ()), (("BSD",), ())]),
    ("Lady Bird Deed", [(("LADY",), ()), (("LBD",), ()), (("ENHANCEDLIFEESTATE",), ())]),
    ("Transfer on Death Deed", [(("TRANSFER",), ()), (("TOD",), ())]),
    ("Sheriff's Deed", [(("SHERIFF",), ("SPECIAL",)), (("SHD",), ("SPECIAL",)), (("SHRF",), ("SPECIAL",)), (("SD",), ("SPECIAL",))]),
    ("Tax Deed", [(("TAX",), ()), (("TX",), ())]),
    ("Trustee's Deed", [(("TRUSTEE",), ()), (("TRD",), ()), (("TR", "DEED"), ("TAX",))]),
    ("Personal Representative Deed", [(("PERSONAL",), ()), (("REPRESENTATIVE",), ()), (("PRD",), ()), (("PERSREP",), ())]),
    ("Correction Deed", [(("CORR",), ()), (("CD",), ())]),
    ("Deed in Lieu of Foreclosure", [(("DIL",), ()), (("DEED", "LIEU"), ())]),
    ("Life Estate Deed", [(("LIFE", "ESTATE"), ()), (("LED",), ())]),
    ("Joint Tenancy Deed", [(("JOINT", "TENANCY"), ()), (("JTD",), ())]),
    ("Tenancy in Common Deed", [(("TENANCY", "COMMON"), ()), (("TIC",), ())]),
    ("Community Property Deed", [(("COMMUNITY", "PROPERTY"), ())]),
    ("Gift Deed", [(("GIFT",), ()), (("GFD",), ())]),
    ("Interspousal Transfer Deed", [(("INTERSPOUSAL",), ()), (("ITD",), ())]),
    ("Wild Deed", [(("WILD",), ())]),
    ("Special Master's Deed", [(("SPECIAL", "MASTER"), ()), (("SMD",), ()), (("SPM",), ())]),
    ("Court Order Deed", [(("COURT", "ORDER"), ()), (("COD",), ())]),
    ("Contract for Deed", [(("CONTRACT",), ()), (("CFD",), ()), (("AGREEMENTFORDEED",), ())]),
    ("Quiet Title Deed", [(("QUIET", "TITLE"), ()), (("QTD",), ())]),
    ("Administrator's Deed", [(("AD",), ())]),
    ("Guardian's Deed", [(("GUARDIAN",), ()), (("GRDN",), ()), (("GDN",), ())]),
    ("Receiver's Deed", [(("RECEIVER",), ()), (("RCV",), ()), (("REC",), ())]),
    ("Right of Way Deed", [(("RIGHT", "WAY"), ()), (("ROW",), ())]),
    ("Vacation of Plat Deed", [(("VACATION", "PLAT"), ()), (("VOP",), ()), (("VAC",), ())]),
    ("Assignment of Contract", [(("ASSIGNMENT",), ()), (("AOC",), ())]),
    ("Release of Contract", [(("RELEASE",), ()), (("ROC",), ())]),
]
#: Names that a text may be a part of, or have as a part, after the letters have said nothing.
DEED_NAMES = [
    ("Warranty Deed", ["warranty deed", "statutory warranty deed", "general warranty deed"]), ("Special Warranty Deed", ["special warranty deed"]), ("Quitclaim Deed", ["quitclaim deed", "quit claim deed", "fee simple"]),
    ("Grant Deed", ["grant deed"]), ("Bargain and Sale Deed", ["bargain and sale deed", "bargain & sale deed"]), ("Lady Bird Deed", ["lady bird deed"]), ("Transfer on Death Deed", ["transfer on death deed"]),
    ("Deed in Lieu of Foreclosure", ["deed in lieu of foreclosure"]), ("Court Order Deed", ["court order deed"]), ("Contract for Deed", ["contract for deed", "agreement for deed"]), ("Quiet Title Deed", ["quiet title deed", "certificate of title"]),
    ("Right of Way Deed", ["right of way deed"]), ("Vacation of Plat Deed", ["vacation of plat deed"]), ("Assignment of Contract", ["assignment of contract"]), ("Release of Contract", ["release of contract"]),
]
#: Texts that say that the type isn't known.
NO_DEED = ["not available", "not-applicable", "unknown", "unavailable"]
#: Record types of permit number prefixes.
RECORD_TYPES = {"COM": "Commercial", "ELE": "Electrical", "FIR": "Fire", "FNC": "Fence", "MEC": "Mechanical", "OCC": "Occupancy", "ROF": "Roof", "SGN": "Sign", "TMP": "Temporary Use", "USE": "Use"}

Rules = list[tuple[str, list[str], list[str]]]


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def by_texts(c: Column, rules: Rules) -> Column:
    """Value of the first rule of which a text occurs (without regard to case; & joins texts that must all) and no other."""
    up = F.upper(c)
    tests = []
    for value, some, none in rules:
        hit = _any([_all([F.contains(up, F.lit(t)) for t in text.split("&")]) for text in some])
        tests.append((value, _all([hit, *[~F.contains(up, F.lit(t)) for t in none]])))
    return first_match(tests)


def improvement_type(description: Column, context: Column | None = None) -> Column:
    """Type of a described improvement; a context that speaks of land means irrigation, all else is general building."""
    text = F.lower(F.coalesce(description, F.lit("")))
    found = first_match([(value, _any([text.rlike(w) if "\\" in w else F.contains(text, F.lit(w)) for w in words])) for value, words in IMPROVEMENTS])
    land = F.when(F.contains(F.lower(context), F.lit("land")), "LandscapeIrrigation") if context is not None else F.lit(None).cast("string")
    return F.coalesce(found, land, F.lit("GeneralBuilding"))


def deed_type(c: Column) -> Column:
    """Normal name of a deed type: by sale code, then by letters, then by names; Miscellaneous if nothing says more."""

    def forms(text: Column) -> Column:
        codes = F.transform(F.filter(F.split(text, "[^0-9A-Za-z]+"), lambda t: t.rlike(r"^\d{1,2}$")), lambda t: F.lpad(t, 2, "0"))
        coded = F.nullif(F.trim(F.regexp_extract(text, r"^\d+\s*[-–:/]\s*(.+)$", 1)), F.lit(""))
        return let(F.coalesce(coded, text), lambda named: F.struct(
            codes.alias("codes"), F.lower(named).alias("low"), F.regexp_replace(F.upper(named), "[^A-Z0-9]+", "").alias("letters"), named.rlike("[a-zA-Z]").alias("lettered"), F.upper(text).rlike(r"^XX(\.?$| )").alias("odd"),
        ))

    # every form is made once: more than a hundred tests look at them
    text = F.trim(F.regexp_replace(F.trim(c), r"\s+", " "))
    return F.coalesce(let(let(text, forms), _deed_type), F.lit("Miscellaneous"))


def _deed_type(t: Column) -> Column:
    low, letters = t["low"], t["letters"]
    by_code = [(value, F.array_contains(t["codes"], F.lit(code))) for code, value in DEED_CODES]
    nothing = ~t["lettered"] | low.isin("n/a", "na") | _any([F.contains(low, F.lit(x)) for x in NO_DEED])
    tests = []
    for value, some in DEED_LETTERS:
        tests.append((value, _any([_all([F.contains(letters, F.lit(x)) for x in every] + [~F.contains(letters, F.lit(x)) for x in none]) for every, none in some])))
    tests += [(value, _any([F.contains(low, F.lit(n)) | F.contains(F.lit(n), low) for n in names])) for value, names in DEED_NAMES]
    return first_match([("Miscellaneous", t["odd"]), *by_code, ("Miscellaneous", nothing), *tests])


def record_type(number: Column) -> Column:
    """Record type of a permit number's leading letters; null for others."""
    types = F.create_map(*[F.lit(x) for pair in RECORD_TYPES.items() for x in pair])
    return F.try_element_at(types, F.upper(F.regexp_extract(number, "^([A-Za-z]+)", 1)))


def unit_count(n: Column) -> Column:
    """Words for one to four units; null for other numbers."""
    return F.get(F.array(*map(F.lit, ["One", "Two", "Three", "Four"])), F.when(n.between(1, 4) & (n == F.floor(n)), n.cast("int") - 1))


def building_value(market: Column, land: Column) -> Column:
    """What a market value leaves over its land, to two decimals; null unless above zero."""
    rest = market - land
    return F.when(rest > 0, F.round(rest, 2))


def year_start(c: Column) -> Column:
    """YYYY-01-01 of a year from 1800 to 2100, given at the beginning of the text; null otherwise."""
    year = F.regexp_extract(F.trim(c), r"^(\d+)", 1).try_cast("int")
    return F.when(year.between(1800, 2100), F.format_string("%04d-01-01", year))


def us_date(day: Column) -> Column:
    """MM/DD/YYYY of an ISO day."""
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat_ws("/", F.substring(day, 6, 2), F.substring(day, 9, 2), F.substring(day, 1, 4)))


def window_key(start: Column, end: Column) -> Column:
    return F.concat_ws("_", F.translate(start, "-", ""), F.translate(end, "-", ""))
