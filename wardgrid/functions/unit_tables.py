"""Spellings of units and conversions between them."""

from __future__ import annotations

# Spellings, lower case without blanks and full stops, of each unit of the units table.
SPELLINGS: dict[str, tuple[str, ...]] = {
    "mmHg": ("mmhg", "mm(hg)", "torr"),
    "kPa": ("kpa", "kilopascal"),
    "cmH2O": ("cmh2o", "cmwater", "cm(h2o)"),
    "mbar": ("mbar", "millibar", "hpa"),
    "/min": ("/min", "1/min", "permin", "bpm", "slagen/min", "perminuut", "perminute", "min-1"),
    "%": ("%", "pct", "perc", "procent", "percent"),
    "fraction": ("fraction", "fractie", "frac", "0-1"),
    "°C": ("°c", "c", "grc", "degc", "celsius", "graadc"),
    "°F": ("°f", "f", "grf", "degf", "fahrenheit", "graadf"),
    "mmol/l": ("mmol/l", "mmolperliter", "mm", "mmolperl", "millimol/l"),
    "mg/dl": ("mg/dl", "mgperdl", "mg%", "mg/100ml"),
    "µmol/l": ("umol/l", "mcmol/l", "micromol/l", "umolperl", "um"),
    "mEq/l": ("meq/l", "meqperl"),
    "g/dl": ("g/dl", "gr/dl", "gram/dl", "g%"),
    "g/l": ("g/l", "gram/l", "gr/l"),
    "mg/l": ("mg/l", "mgperl"),
    "10^9/l": ("10^9/l", "x10^9/l", "10*9/l", "e9/l", "10e9/l", "g/ltromb", "giga/l"),
    "/µl": ("/ul", "cells/ul", "perul", "/mm3"),
    "K/µl": ("k/ul", "10^3/ul", "x1000/ul", "x10^3/ul", "10*3/ul"),
    "ml": ("ml", "cc", "milliliter"),
    "l": ("l", "liter", "ltr", "litre"),
    "l/min": ("l/min", "lpm", "liter/min", "lperminute"),
    "ml/min": ("ml/min", "cc/min", "mlpermin"),
    "kg": ("kg", "kilo", "kilogram"),
    "g": ("g", "gr", "gram", "grams"),
    "lb": ("lb", "lbs", "pound", "pounds"),
    "cm": ("cm", "centimeter"),
    "m": ("m", "mtr", "meter"),
    "inch": ("inch", "in", "inches", '"'),
    "pH": ("ph",),
}

# Texts that name no unit, in the same form.
NO_UNIT = ("", "none", "geen", "-", "0")

# y = a * x + b between units of one quantity, whatever is measured.
GENERAL_EDGES: tuple[tuple[str, str, float, float], ...] = (
    ("kPa", "mmHg", 7.500617, 0.0),
    ("cmH2O", "mmHg", 0.735559, 0.0),
    ("mbar", "cmH2O", 1.019716, 0.0),
    ("kPa", "mbar", 10.0, 0.0),
    ("fraction", "%", 100.0, 0.0),
    ("°C", "°F", 1.8, 32.0),
    ("mmol/l", "µmol/l", 1000.0, 0.0),
    ("g/dl", "g/l", 10.0, 0.0),
    ("g/l", "mg/l", 1000.0, 0.0),
    ("mg/dl", "mg/l", 10.0, 0.0),
    ("K/µl", "10^9/l", 1.0, 0.0),
    ("K/µl", "/µl", 1000.0, 0.0),
    ("l", "ml", 1000.0, 0.0),
    ("l/min", "ml/min", 1000.0, 0.0),
    ("kg", "g", 1000.0, 0.0),
    ("lb", "kg", 0.45359237, 0.0),
    ("m", "cm", 100.0, 0.0),
    ("inch", "cm", 2.54, 0.0),
)

# Mg in a mmol (molar mass, of haemoglobin's monomer by custom), and charge, by item tag.
MOLAR_MASS = {"glucpoc": 180.156, "gluclab": 180.156, "kreat": 113.12, "ureum": 60.056, "lact": 90.08, "hb": 16114.0, "bili": 584.66, "ca": 40.078, "mg": 24.305, "na": 22.99, "k": 39.098, "cl": 35.453, "hco3": 61.017}
CHARGE = {"na": 1, "k": 1, "cl": 1, "hco3": 1, "ca": 2, "mg": 2}
