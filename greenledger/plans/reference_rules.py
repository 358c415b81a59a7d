"""Rule tables for the real catalog publisher's labels.

These are the values the published dimension depends on; a user of real
catalog data passes them to ``clean_catalog``. Other data brings its own.
"""

from greenledger.operators.rules import NameRule, TerritoryRule

# ---------------------------------------------------------------------------
# Fixed values (must equal the published semantics), in rule order.
# Test fields: sub = mapped-else-original sub-category, sub_new = mapped only,
# category_new = mapped category; see greenledger.operators.rules.
# ---------------------------------------------------------------------------
CATALOG_NAME_RULES = [
    NameRule("sub", ("Hotel stay",), "{sub_orig} - {name}"),
    NameRule("sub_new", ("Cars",), "{name} - {text}"),
    NameRule("sub", ("Motorbike",), "{name} {sub_orig_lower_first}"),
    NameRule("sub", ("WTT- Motorbike",), "WTT- {name} motorbike"),
    NameRule("sub", ("Heavy Goods Vehicles", "Heavy Goods Vehicles - Refrigerated", "Vans",
                     "WTT- Heavy Goods Vehicles", "WTT- Heavy Goods Vehicles - Refrigerated",
                     "WTT- Vans", "WTT- Cars"), "{sub} - {name} - {text}"),
    NameRule("sub", ("Cargo Ship",), "{name} - {sub} - {level4}"),
    NameRule("sub", ("WTT- Cargo Ship",), "WTT- {name} - Cargo - {level4}"),
    NameRule("sub", ("Electricity", "WTT- Electricity", "Electricity T&D", "WTT- Electricity (T&D)",
                     "WTT- district heat & steam distribution"), "{sub_new}"),
    NameRule("category_new", ("Waste", "Materials"), "{name} - {text}"),
    NameRule("sub", ("Ferry", "WTT- ferry"), "{sub} -{name}"),
    NameRule("sub", ("WTT- biomass", "WTT- heat and steam", "WTT- biogas", "WTT- fuels", "WTT- Bus",
                     "WTT- Taxis", "WTT- Rail", "WTT- Freight Flights", "WTT- Sea Tanker",
                     "WTT- biofuel"), "WTT- {name}"),
]

CATALOG_TERRITORY = TerritoryRule(
    "sub",
    ("Electricity", "WTT- Electricity", "Electricity T&D", "Heat and steam", "WTT- heat and steam",
     "WTT- UK electricity (T&D)", "WTT- district heat & steam distribution"),
    "GB",
)

# The category whose rows take the category as their sub-category.
CATALOG_REWRITE_CATEGORY = "WTT- fuels"
