"""Fixed values that results depend on: word lists, maps, bounds and thresholds."""

# Raw facility types in lookup order, and the valid types.
TYPE_MAPPING = {
    "sx-ew": "hydromet_plant", "sxew": "hydromet_plant", "sx ew": "hydromet_plant", "solvent extraction": "hydromet_plant", "sx/ew": "hydromet_plant", "heap leach": "heap_leach", "heap-leach": "heap_leach",
    "rod mill": "rolling_mill", "wire mill": "rolling_mill", "wire rod mill": "rolling_mill", "steelworks": "steel_plant", "steel works": "steel_plant", "steel mill": "steel_plant", "steel plant": "steel_plant",
    "battery recycle": "battery_recycling", "battery recycling": "battery_recycling", "recycling plant": "battery_recycling", "battery plant": "battery_recycling",
    "processing plant": "processing_plant", "processing": "processing_plant", "process plant": "processing_plant", "mine": "mine", "smelter": "smelter", "refinery": "refinery", "concentrator": "concentrator",
    "plant": "plant", "mill": "mill", "tailings": "tailings", "exploration": "exploration", "development": "development",
}
# Synonyms used by the importer.
METALS = {
    "aluminium": "aluminum", "ferronickel": "nickel", "ferromanganese": "manganese", "chromite": "chromium", "pgm": "platinum", "pge": "platinum", "ree": "rare earths", "rare earth elements": "rare earths",
    "fe": "iron", "cu": "copper", "au": "gold", "ag": "silver", "zn": "zinc", "pb": "lead", "ni": "nickel", "co": "cobalt", "li": "lithium", "u": "uranium", "hg": "mercury",
    "gemstones": "precious stones", "lapis lazuli": "precious stones", "ruby": "precious stones", "emerald": "precious stones", "barium": "baryte", "barite": "baryte",
}
TYPES = {
    "open pit mine": "mine", "underground mine": "mine", "surface mine": "mine", "coal mine": "mine", "deposit": "mine", "quarry": "mine", "smelter": "smelter", "refinery": "refinery", "processing facility": "plant",
    "processing complex": "plant", "steel complex": "plant", "steelworks": "plant", "cement plant": "plant", "cement factory": "plant", "fertilizer complex": "plant", "concentrator": "concentrator",
}
STATUSES = {
    "operational": "operating", "operating": "operating", "active": "operating", "operational (old)": "operating", "in development": "construction", "under construction": "construction", "executable": "construction",
    "proposed": "planned", "planned": "planned", "contracted": "planned", "feasibility": "planned", "pre-feasibility": "planned", "bankable": "planned", "closed": "closed", "inactive": "closed", "completed": "closed",
    "suspended": "suspended", "stalled": "suspended", "care and maintenance": "suspended", "dormant": "suspended", "dormant (l/r)": "suspended", "cancelled": "closed", "grassroots": "planned",
}
STATUS_WORDS = "operational|operating|active|construction|proposed|planned|closed|inactive|suspended|stalled|undeveloped|relaunching"
BASKETS = {
    "ree": "ree", "rare earth": "ree", "rare earths": "ree", "rare-earth": "ree", "rare-earths": "ree", "pgm": "pgm", "pgms": "pgm", "platinum group": "pgm", "platinum group metal": "pgm", "platinum group metals": "pgm",
    "base": "base", "base metal": "base", "base metals": "base", "battery": "battery", "battery metal": "battery", "battery metals": "battery", "precious": "precious", "precious metal": "precious", "precious metals": "precious",
    "ferroalloy": "ferroalloy", "ferroalloys": "ferroalloy", "ferro": "ferroalloy", "specialty": "specialty", "specialty metal": "specialty", "specialty metals": "specialty", "industrial": "industrial", "nuclear": "nuclear",
}
ASSET_TYPES = {"mine": "Mine", "plant": "Plant", "smelter": "Smelter", "refinery": "Refinery", "concentrator": "Concentrator", "processing_plant": "Plant"}
NOISE_WORDS = ("project", "operation", "operations", "complex", "property", "deposit", "district", "mine", "pit", "shaft", "open pit", "open-pit", "underground", "plant", "mill", "smelter", "refinery", "concentrator", "sx-ew", "sxew", "hydromet", "works")
GENERIC_NAMES = (r"^mine \d+$", r"^facility \d+$", r"^project \d+$", "^unknown", "^unnamed", "^tbd$")
# Bounds as lat_min, lat_max, lon_min, lon_max.
BBOX = {
    "ARM": (38.8, 41.3, 43.4, 46.6), "AUS": (-44.0, -10.0, 113.0, 154.0), "BEL": (49.5, 51.5, 2.5, 6.4), "BFA": (9.4, 15.1, -5.5, 2.4), "BRA": (-34.0, 6.0, -74.0, -34.0), "CAN": (41.0, 84.0, -141.0, -52.0),
    "CHL": (-56.0, -17.0, -110.0, -66.0), "CHN": (18.0, 54.0, 73.0, 135.0), "IDN": (-11.0, 6.0, 95.0, 141.0), "IND": (6.0, 36.0, 68.0, 98.0), "MEX": (14.0, 33.0, -118.0, -86.0), "PER": (-19.0, 0.0, -82.0, -68.0),
    "RUS": (41.0, 82.0, 19.0, -169.0), "TCD": (7.0, 24.0, 13.0, 24.5), "USA": (24.0, 72.0, -180.0, -66.0), "ZAF": (-35.0, -22.0, 16.0, 33.0), "ZMB": (-18.0, -8.0, 22.0, 34.0),
    "ARG": (-55.0, -21.0, -74.0, -53.0), "BOL": (-23.0, -9.0, -70.0, -57.0), "ECU": (-5.0, 2.0, -92.0, -75.0), "VEN": (0.0, 13.0, -74.0, -59.0), "FRA": (-21.0, 51.0, -62.0, 10.0),
}
#: Countries whose box does not hold back a new position.
WRITE_BBOX = {k: v for k, v in BBOX.items() if k not in ("ARG", "BOL", "ECU", "VEN", "FRA")}
FIX_BOUNDS = {"AUS": (-44, -10, 112, 154), "BRA": (-34, 5, -74, -34), "IDN": (-11, 6, 95, 141), "SAU": (16, 32, 34, 56), "ZAF": (-35, -22, 16, 33), "CHL": (-56, -17, -76, -66), "BOL": (-23, -9, -69, -57), "USA": (24, 72, -180, -66)}
SENTINEL = (21.7713519, -72.2788891)
NORTHERN = (
    "SAU", "ARE", "OMN", "YEM", "QAT", "KWT", "BHR", "IRQ", "IRN", "JOR", "LBN", "SYR", "ISR", "PSE", "AFG", "PAK", "NPL", "BTN", "BGD", "MMR", "THA", "LAO", "VNM", "KHM",
    "PHL", "CHN", "MNG", "KOR", "PRK", "JPN", "TWN", "USA", "CAN", "MEX", "GTM", "BLZ", "SLV", "HND", "NIC", "CRI", "PAN", "CUB", "HTI", "DOM", "JAM", "TTO", "MAR", "DZA",
    "TUN", "LBY", "EGY", "MRT", "MLI", "NER", "TCD", "SDN", "SSD", "ERI", "DJI", "ETH", "SEN", "GMB", "GNB", "GIN", "SLE", "LBR", "CIV", "GHA", "TGO", "BEN", "BFA", "NGA",
    "CMR", "CAF", "ESP", "PRT", "FRA", "BEL", "NLD", "DEU", "POL", "CZE", "SVK", "AUT", "CHE", "ITA", "GRC", "TUR", "ROU", "BGR", "HUN", "HRV", "SVN", "BIH", "SRB", "MNE",
    "MKD", "ALB", "KOS", "GBR", "IRL", "ISL", "NOR", "SWE", "FIN", "DNK", "EST", "LVA", "LTU", "BLR", "UKR", "MDA", "RUS", "GEO", "ARM", "AZE", "KAZ", "UZB", "TKM", "TJK",
    "KGZ",
)
LON_NEAR_1 = ("FRA", "DZA", "BFA", "NER", "BEN", "TGO", "GHA", "GBR", "AND", "ESP")
KNOWN_FIXES = {
    "aus-mount-newman-fac": (-23.361111, 119.7325), "aus-yandicoogina-fac": (-22.776192, 119.2), "idn-earthstone-nalo-baru-mine-fac": (-2.01394, 101.5), "sau-jabal-sayid-fac": (24.276714683519764, 45.51155643412581),
    "bol-bolivar-mine-fac": (-19.5, -66.1), "ncl-snowy-river-project-fac": (-22.3, 166.5), "kor-sangdong-mine-fac": (37.15, 128.7),
}
KNOWN_DELETES = ("tkm-jv-inkai-fac",)
GATES = {"strict": (0.90, 0.80), "moderate": (0.85, 0.70), "permissive": (0.80, 0.60)}
TABLE_WORDS = ("site", "mine", "facility", "name", "deposit", "project", "latitude", "longitude", "commodity", "commodities", "metal", "metals", "operator", "owner", "location", "province", "region")
SITE_HEADERS = ("site", "mine name", "mine/project name", "project name", "facility name", "asset name")
NOT_NAMES = (
    "^-+$", "^n/?a$", "^tbd$", "^unknown$", "^note:", r"^\(note", "this table", "representative compilation", "^no other (name|known)", "^not (specified|identified|available)",
    "^no (steel|processing|facilit(?:y|ies)|industry|smelters)", "no .+ exist", "net importer", "^generic potential", "^uneconomic traces", "^potential noted", "^.{1,2}$",
)
