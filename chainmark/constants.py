"""Fixed values of the domain: they must stay as they are for results to agree."""

# Lines in the order in which they are searched.
LINES = ["TLX", "MLX", "SML", "EML"]

# Chainage (km) at the start of each line.
LINE_START_KM = {"TLX": -3.7, "MLX": 26.9, "SML": 174.0, "EML": 288.7}

# Fixed value: chainage (km) where TLX ends and MLX begins.
TLX_END_KM = 26.9

# How each line's segments get their chainage; TLX is counted back from its end.
LINE_CHAINAGES = {
    "TLX": {"chainage_end": 26.9, "reverse": True},
    "MLX": {"chainage_start": 26.9},
    "SML": {"chainage_start": 174.0},
    "EML": {"chainage_start": 288.7},
}

# Centreline layer name of each line.
LAYER_LINES = {"Mainline": "MLX", "Solomon Spur": "SML", "Eliwana Mainline": "EML"}

# Line code (second part of a measurement id) to line.
MAIN_LINE_CODES = {"MLB": "MLX", "MLW": "MLX", "SLB": "SML", "SLW": "SML", "SLE": "SML", "ELB": "EML"}

# Fixed value: line given to codes that are not on a main line.
OTHER_LINE = "OTH"

# Region (first part of a measurement id) to line.
REGION_LINES = {
    "MLB": "MLX", "MLW": "MLX", "CBM": "MLX", "Thomas": "TLX", "Barker": "MLX", "Canning": "MLX",
    "Chapman": "MLX", "Forrest-I": "MLX", "Forrest-II": "MLX", "Hillside": "MLX", "Gibb": "MLX",
    "Coonarie": "MLX", "Nunna": "MLX", "Nunna-2": "SML", "Hunter": "MLX", "Summit": "MLX",
    "Morgan": "MLX", "Maddina": "MLX", "CloudBreaker": "MLX", "Jones": "MLX", "Christmas Creek": "MLX",
    "Avon": "SML", "Bea Bea": "SML", "Bow": "SML", "Capel": "SML", "Firetail": "SML", "Future": "SML",
    "De Grey": "EML", "De Gray": "EML", "Duck": "EML", "Eliwana": "EML",
}

# Text repairs of measurement ids, applied in this order.
ID_REPAIRS = [("Jones to CCK_MLE", "Jones to CCK_MLB"), ("Jones to CCK", "Jones")]

# Named points of interest (working CRS, metres).
POINTS_OF_INTEREST = [("origin", 662669.066, 7746597.522), ("mainline_start", 664948.312, 7721405.294)]

# Section class to parameter to limit; head loss differs by inside (lo) and outside (hi) rail.
THRESHOLDS = {
    "tangent": {"vert_wear": 16, "side_wear": 4, "rel_head_loss": {"lo": 40, "hi": 40}},
    "mild_curve": {"vert_wear": 14, "side_wear": 6, "rel_head_loss": {"lo": 32, "hi": 37}},
    "sharp_curve": {"vert_wear": 10, "side_wear": 6, "rel_head_loss": {"lo": 25, "hi": 25}},
}

# Measured column to short name used in the statistics.
WEAR_MEASURES = {
    "east_vertical_wear": "e_vert_wear", "west_vertical_wear": "w_vert_wear",
    "east_gauge_side_wear": "e_side_wear", "west_gauge_side_wear": "w_side_wear",
    "east_relative_head_loss": "e_rel_head_loss", "west_relative_head_loss": "w_rel_head_loss",
}

# Speed columns summarised per section.
SPEED_MEASURES = ["speed", "post_speed"]

# Status order. The string lists the west rail first; flags cover these metrics.
STATUS_PARAMS = ["rel_head_loss", "vert_wear", "side_wear"]
STATUS_METRICS = ["avg", "p50", "p75", "p90"]
STATUS_SCORES = {"G": 0, "A": 1, "R": 3}

# Yearly plan columns left out of the segment attributes.
EXCLUDED_ATTRIBUTES = ["2022", "2023", "2024", "2025"]

# Header-like texts found in the section column.
SECTION_HEADERS = ["nan", "LINE", "Section"]

# Network export.
HYBRID_TAGS = ["ug-closure", "oh-closure"]
HYBRID_SPEC = "96-port"
DEMAND_SPEC = "niu"
ASSIGNMENT_SPEC = "leadin"
ID_PREFIXES = {"devices": "fd", "parcels": "p", "assignments": "a", "ducts": "ug-duct", "cables": "fc", "path": "path"}

# Layer name to the geometry kind it must hold.
LAYER_KINDS = {"path": "LineString", "points": "Point", "boundary": "Polygon",
               "hub_locations": "Point", "blocks": "LineString"}
