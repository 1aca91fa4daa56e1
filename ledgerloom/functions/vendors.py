"""Permit portal vendors: classification of pages, of stated vendor texts, and the verdict on a catalog row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (key, name, patterns of addresses, texts of pages), in order.
VENDORS = [
    ("accela", "Accela Citizen Access", [r"\.accela\.com/", "aca-?prod"], ["Accela"]),
    ("tyler_epl", "Tyler EPL / Civic Access", ["civicaccess", "energov", r"\.tylertech", r"permit-planner\.", r"tylerhost\.net", "energovweb", r"munisselfservice\.com", "edenweb", r"eden\.[a-z]", r"Default\.aspx\?Build=PM\.pmPermit"], ["Civic Access", "EnerGov", "Tyler", "Munis", "EDEN", "Self Service"]),
    ("click2gov", "Click2Gov", ["click2gov", r"aspgov\.com"], ["Click2Gov"]),
    ("opengov", "OpenGov", [r"\.opengov\.com", r"viewpoint\.opengov"], ["OpenGov"]),
    ("centralsquare", "CentralSquare / eHub", ["centralsquare", r"\beHub\b", "esuite", r"eSuite\.Permits"], ["CentralSquare", "eHub"]),
    ("epzb", "ePZB (county custom)", ["epzb", "ipzb"], ["ePZB"]),
    ("govaccess", "GovAccess", [r"govaccess\.org"], ["GovAccess"]),
    ("mygov", "MyGovernmentOnline (MGO)", [r"mgoconnect\.org", "mygovernmentonline"], ["My Government Online", "MGO Connect"]),
    ("bsa", "BS&A Online", [r"bsaonline\.com"], ["BS&A", "bsaonline"]),
    ("sagesgov", "SagesGov", [r"sagesgov\.com"], ["SagesGov"]),
    ("municipalonline", "Municipal Online", [r"municipalonlinepayments\.com"], ["Municipal Online"]),
    ("maintstar", "MaintStar", [r"maintstar\.co"], ["MaintStar", "Maintstar Permit"]),
    ("geocivix", "GeoCivix", [r"geocivix\.com"], ["GeoCivix"]),
    ("cityview", "CityView (Harris)", ["cityviewportal", "/cityview"], ["CityView"]),
    ("iworq", "iWorq", [r"iworq\.net"], ["iWorq"]),
]
#: A key that stands for others too.
FAMILIES = {"centralsquare": ["click2gov"]}
#: Words of pages about permits.
EVIDENCE = ["permit", "permitting", "inspection", "certificate of occupancy", "building division", "plan review", "click2gov", "civic access", "energov", "citizen ?access", "ehub"]


def has_evidence(html: Column) -> Column:
    """Whether a page speaks of permits; false for null."""
    return F.coalesce(html.rlike(rf"(?i)\b({'|'.join(EVIDENCE)})\b"), F.lit(False))


def vendor(url: Column, html: Column) -> Column:
    """struct(key, name, confidence): the first vendor whose address matches (url), else whose text occurs (html)."""
    address, page = F.coalesce(url, F.lit("")), F.lower(F.coalesce(html, F.lit("")))

    def found(key: str, name: str, how: str) -> Column:
        return F.struct(F.lit(key).alias("key"), F.lit(name).alias("name"), F.lit(how).alias("confidence"))

    by_url = [F.when(address.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), found(key, name, "url")) for key, name, patterns, _ in VENDORS]
    by_page = []
    for key, name, _, markers in VENDORS:
        test = F.lit(False)
        for m in markers:
            test = test | F.contains(page, F.lit(m.lower()))
        by_page.append(F.when(test, found(key, name, "html")))
    return F.coalesce(*by_url, *by_page, found("unknown", "unknown", "none"))


def stated_keys(text: Column) -> Column:
    """array of the vendor keys that a free text names by key, name or page text, with the keys that these stand for."""
    low = F.lower(F.coalesce(text, F.lit("")))
    named = []
    for key, name, _, markers in VENDORS:
        test = F.lit(False)
        for t in (key, name, *markers):
            test = test | F.contains(low, F.lit(t.lower()))
        named.append(F.when(test, F.array(*map(F.lit, [key, *FAMILIES.get(key, [])]))))
    return F.array_distinct(F.flatten(F.filter(F.array(*named), lambda k: k.isNotNull())))


def verdict(found_key: Column, stated: Column, html: Column) -> Column:
    """PASS if the page is of a stated vendor and speaks of permits, else REVIEW."""
    return F.when(F.array_contains(stated_keys(stated), found_key) & has_evidence(html), "PASS").otherwise("REVIEW")
