"""A handful of invented business records for smoke runs and tests; the test split has a country of its own."""

from __future__ import annotations

from pathlib import Path

TRAIN = {
    1: [
        ("S1-00001", "Nilgiri Tea Traders Pvt Ltd", "18 Lake View Road, Coonoor 643101", "India"),
        ("S1-00002", "Copper Kettle Brewing Corp", "902 Harbor Blvd, Unit 4, Portland, ME 04101", "US"),
        ("S1-00003", "Larkspur Piano Tuning", "7 Alder Lane, Boise, ID 83702", "US"),
        ("S1-00004", "Meenakshi Silk House", "West Tower Street, Madurai", "India"),
    ],
    2: [
        ("S2-00010", "Nilgiri Tea Traders Private Limited", "18, Lakeview Rd, Coonoor", "India"),
        ("S2-00020", "Copper Kettle Brewers", "902 Harbor Boulevard, Portland", "US"),
        ("S2-00030", "Granite State Towing", "55 Quarry Rd, Concord, NH", "US"),
    ],
    3: [
        ("S3-00100", "Nilgiri Tea Traders", "Lake View Road, Coonoor 643101", "India"),
        ("S3-00200", "Meenakshi Silks", "Opp. West Tower, Tower St, Madurai", "India"),
    ],
}
TRUTH = {"S1-00001": ["S2-00010", "S3-00100"], "S1-00002": ["S2-00020"], "S1-00003": [], "S1-00004": ["S3-00200"]}
TEST = {
    1: [
        ("S1-10001", "Atelier du Moulin SARL", "3 quai des Tanneurs, Colmar 68000", "France"),
        ("S1-10002", "Sable Point Boat Works Inc", "12 Dune Road, Ludington, MI 49431", "US"),
        ("S1-10003", "Hooghly Jute Mills", "44 Strand Road, Kolkata 700001", "India"),
    ],
    2: [
        ("S2-10010", "Atelier du Moulin", "3, quai des Tanneurs, Colmar", "France"),
        ("S2-10020", "Sable Point Boatworks", "12 Dune Rd, Ludington", "US"),
    ],
    3: [("S3-10100", "Hooghly Jute Mill Ltd", "Strand Rd 44, Kolkata", "India"), ("S3-10200", "Vosges Cartonnage SA", "9 rue Basse, Epinal", "France")],
}


def generate(folder: str) -> None:
    """Write the sources of both splits and the ground truth as tab-separated files into a local folder."""
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    for prefix, split in (("train", TRAIN), ("test", TEST)):
        for k, rows in split.items():
            lines = ["entity_id\tbusiness_name\tbusiness_address\tcountry"] + ["\t".join(r) for r in rows]
            (path / f"{prefix}_source{k}.tsv").write_text("\n".join(lines) + "\n")
    lines = ["source1_entity_id\tmatched_entity_ids"] + [f"{k}\t{','.join(v)}" for k, v in TRUTH.items()]
    (path / "train_ground_truth.tsv").write_text("\n".join(lines) + "\n")
