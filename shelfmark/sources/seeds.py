"""Vendor whitelist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Vendors known to be valid.
VALID_VENDORS: tuple[str, ...] = (
    "1017 ALYX 9SM",
    "3.1 Phillip Lim",
    "A.P.C.",
    "Acne Studios",
    "Aesther Ekme",
    "Alaïa",
    "Alexander McQueen",
    "Alexander Wang",
    "Altuzarra",
    "Anya Hindmarch",
    "Ba&sh",
    "Balenciaga",
    "Balmain",
    "Bao Bao Issey Miyake",
    "Berluti",
    "Blumarine",
    "Bottega Veneta",
    "Brunello Cucinelli",
    "Bulgari",
    "Burberry",
    "Bvlgari",
    "By Far",
    "Canada Goose",
    "Cartier",
    "Casadei",
    "Celine",
    "Cesta",
    "Chanel",
    "Chloé",
    "Christian Dior",
    "Christian Louboutin",
    "Clare V.",
    "Coach",
    "Coperni",
    "Courreges",
    "Craig Green",
    "Cult Gaia",
    "DSquared2",
    "Delcore",
    "Delvaux",
    "Demellier",
    "Diesel",
    "Dior",
    "Dolce & Gabbana",
    "Dries Van Noten",
    "Edie Parker",
    "Elleme",
    "Emilio Pucci",
    "Ermanno Scervino",
    "Etro",
    "Fabiana Filippi",
    "Fendi",
    "Ferragamo",
    "Frances Patiky Stein",
    "Gabriela Coll Garments",
    "Givenchy",
    "Globe-Trotter",
    "Goyard",
    "Gucci",
    "Heimat Atlantica",
    "Hermès",
    "Issey Miyake",
    "JW Anderson",
    "JW PEI",
    "Jacquemus",
    "Jamin Puech",
    "Jean Paul Gaultier",
    "Jenn Lee",
    "Jil Sander",
    "Jimmy Choo",
    "Judith Leiber",
    "Kenzo",
    "Lacoste",
    "Lafayette 148",
    "Lemaire",
    "Loeffler Randall",
    "Loewe",
    "Longchamp",
    "Louis Vuitton",
    "MCM",
    "MISBHV",
    "Mach & Mach",
    "Maison Margiela",
    "Mansur Gavriel",
    "Marc Jacobs",
    "Marni",
    "Marzook",
    "Max Mara",
    "Miu Miu",
    "Moncler",
    "Montblanc",
    "Moschino",
    "Moynat",
    "Mulberry",
    "Nancy Gonzalez",
    "Off-White",
    "Oroton",
    "Ottolinger",
    "Palace",
    "Pierre Hardy",
    "Pleats Please Issey Miyake",
    "Prada",
    "Proenza Schouler",
    "Rabanne",
    "Rag & Bone",
    "Ratio Et Motus",
    "Red Valentino",
    "Rimowa",
    "Roger Vivier",
    "Saint Laurent",
    "Salvatore Ferragamo",
    "Savette",
    "See by Chloé",
    "Self-Portrait",
    "Senreve",
    "Simon Miller",
    "Simone Rocha",
    "Staud",
    "Stella McCartney",
    "Studio Nicholson",
    "Telfar",
    "The Row",
    "Thom Browne",
    "Tod's",
    "Tom Ford",
    "Ulla Johnson",
    "VBH",
    "VSP Archive",
    "Valentino",
    "Valentino Garavani",
    "Versace",
    "Victoria Beckham",
    "Vivienne Westwood",
    "Whiting & Davis",
    "YSL",
    "Yuzefi",
    "Yves Salomon",
)


def load_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One-column whitelist: a CSV file with header, or the built-in list without a path."""
    if path is None:
        return spark.createDataFrame([(v,) for v in VALID_VENDORS], "vendor string")
    return spark.read.option("header", True).schema("vendor string").csv(path)
