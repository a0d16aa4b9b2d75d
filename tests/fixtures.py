"""Paths and small tables that tests import; fixtures themselves are in conftest.py."""

import os
from pathlib import Path

DATA = Path(os.environ.get("PALATE_TESTDATA", "/root/testdata"))

RATINGS = [
    (1, 1, 4.0), (1, 3, 4.0), (1, 6, 4.0), (2, 1, 5.0), (2, 2, 3.0), (2, 3, 4.0),
    (3, 2, 4.0), (3, 5, 5.0), (3, 6, 3.0), (4, 1, 2.0), (4, 4, 4.0), (4, 5, 3.0),
]

MOVIES = [
    (1, "Toy Story (1995)", "Adventure|Animation|Children|Comedy|Fantasy"),
    (2, "Jumanji (1995)", "Adventure|Children|Fantasy"),
    (3, "Grumpier Old Men (1995)", "Comedy|Romance"),
    (4, "Waiting to Exhale (1995)", "Comedy|Drama|Romance"),
    (5, "Father of the Bride Part II (1995)", "Comedy"),
    (6, "Heat (1995)", "Action|Crime|Thriller"),
]

FEEDBACK = [
    (1, 171495, 3.0, 1758027399), (1, 171495, 2.5, 1758028240), (1, 171495, 2.5, 1758028245),
    (15, 171495, 4.0, 1758029381), (4, 171495, 4.5, 1758092298), (1, 171495, 1.0, 1758182624),
]
