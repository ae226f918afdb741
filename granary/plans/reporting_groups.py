"""Reporting groups of Dutch category paths, and the rules by which labels of one path are weighed against each other.

Which labels stand for a group, which words of names do, and which products were reviewed is data that a Spec brings along.
"""

from __future__ import annotations

from granary.operators.decisions import PathRules, Withheld

# The codes and names of the reporting groups.
GROUPS = {
    "fresh_produce": "Fresh Produce",
    "meat_poultry_seafood": "Meat, Poultry & Seafood",
    "dairy_eggs": "Dairy & Eggs",
    "bakery": "Bakery",
    "chilled_prepared": "Chilled & Prepared Foods",
    "frozen": "Frozen Foods",
    "pantry_cooking": "Pantry & Cooking",
    "breakfast_cereals": "Breakfast & Cereals",
    "confectionery_snacks": "Confectionery & Snacks",
    "non_alcoholic_beverages": "Non-Alcoholic Beverages",
    "coffee_tea": "Coffee & Tea",
    "alcoholic_beverages": "Alcoholic Beverages",
    "baby_care": "Baby Care",
    "personal_care": "Personal Care & Hygiene",
    "beauty_cosmetics": "Beauty & Cosmetics",
    "household_care": "Household Care",
    "household_supplies": "Household Paper & Supplies",
    "pet_care": "Pet Care",
    "health_wellness": "Health & Wellness",
    "unclassified": "Other / Unclassified",
    "non_fmcg": "Non-FMCG / General Merchandise",
    "tobacco": "Tobacco",
    "plant_based_alternatives": "Plant-Based Alternatives",
}

# The groups of food and drink.
FOOD = (
    "fresh_produce",
    "meat_poultry_seafood",
    "dairy_eggs",
    "bakery",
    "chilled_prepared",
    "frozen",
    "pantry_cooking",
    "breakfast_cereals",
    "confectionery_snacks",
    "non_alcoholic_beverages",
    "coffee_tea",
    "alcoholic_beverages",
    "plant_based_alternatives",
)

# Labels of promotions and the like; labels that stand for no one group; paths of coffee additions.
PROMOTION = r"\b(?:promo\w*|aanbieding\w*|acties?|recepten?|folder\w*)\b|\d+\s*\+\s*\d+"
AMBIGUOUS = (
    "Afslankingsproducten",
    "Dieet / Vitamines / Voedingssuplementen",
    "Dieetvoeding/Voedingssupplementen",
    "Aardappel (ovenschotel)",
)
COFFEE = Withheld(
    labels=("koffieverrijkers", "koffiemelk, filters, suiker"),
    shop="ah",
    lead=("Frisdrank, sappen, koffie, thee", "Koffie", "Koffieverrijkers"),
    label="zoetstof",
    code="pantry_cooking",
    rule="ah_coffee_sweetener_v1",
)

# Which of several groups of one path wins over which others, in this order, and the rule's id.
PRECEDENCE = (
    ("pet_care", (*FOOD, "pet_care"), "pet_use_over_ingredient"),
    ("baby_care", (*FOOD, "baby_care", "personal_care"), "baby_use_over_ingredient"),
    ("frozen", FOOD, "explicit_frozen_food"),
    ("plant_based_alternatives", ("plant_based_alternatives", "dairy_eggs", "meat_poultry_seafood", "non_alcoholic_beverages"), "explicit_plant_alternative"),
    ("household_supplies", ("household_supplies", "household_care"), "paper_supplies_over_department"),
    ("beauty_cosmetics", ("beauty_cosmetics", "personal_care"), "beauty_over_department"),
    ("health_wellness", ("health_wellness", "personal_care"), "health_over_department"),
    ("dairy_eggs", ("dairy_eggs", "bakery"), "eggs_over_baking_department"),
)

# Labels that draw the line between two groups, asked after those above.
BOUNDARIES = (
    (("gedroogd fruit", "noten & droge vruchten"), ("fresh_produce", "confectionery_snacks"), "confectionery_snacks", "dried_fruit_nuts_over_produce_department"),
    (("vruchtenconserven",), ("fresh_produce", "pantry_cooking"), "pantry_cooking", "canned_fruit_over_produce_department"),
    (("ontbijtrepen",), ("breakfast_cereals", "confectionery_snacks"), "confectionery_snacks", "cereal_bars_are_snacks"),
    (
        ("alcoholvrij", "alcoholvrij bier", "alcoholvrije wijnen & bubbels", "alcoholvrije wijnen", "alcoholvrije aperitieven", "zonder alcohol"),
        ("alcoholic_beverages", "non_alcoholic_beverages"),
        "non_alcoholic_beverages",
        "explicit_alcohol_free",
    ),
)

# A site's navigation that stands before some paths of one shop, market and language.
NAVIGATION_CONTEXT = ("crf", "be", "nl")
NAVIGATION = (
    "Online boodschappen",
    "Online bestellen",
    "Data\nAlles",
    "Promos, online shopping",
    "Onze promoties",
    "Data\nAlles",
    "Carrefour Bonus Card en andere diensten",
    "Onze diensten",
    "Data\nAlles",
    "Recepten, Nieuws",
    "Beter eten",
    "Data\nAlles",
    "Online bestellen",
    "Data",
    "Onze promoties",
    "Data",
    "Onze diensten",
    "Data",
    "Beter eten",
    "Data",
    "Shop online",
)

DUTCH = PathRules(
    language="nl",
    promotion=PROMOTION,
    ambiguous=AMBIGUOUS,
    withheld=(COFFEE,),
    precedence=PRECEDENCE,
    boundaries=BOUNDARIES,
    prefix="nl_label_",
)
