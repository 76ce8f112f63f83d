"""Queries and domains with the outcome of each rule, worked out in another engine."""

NAMES = ("thai", "indian", "pizza", "mediterranean")

# query, domain, cleaned, score, substring, tokens, prefix, excluded, override, branded
ROWS = [
    ("pizza dados", "dadospizzaok.com", "pizza dado", 69, 0, 1, 0, 0, 0, 1),
    ("dadospizzaok", "dadospizzaok.com", "dadospizzaok", 100, 1, 0, 1, 0, 0, 1),
    ("ovn bellingham", "ovnwoodfiredpizza.com", "ovn bellingham", 53, 0, 0, 1, 0, 0, 1),
    ("thai", "thaibasil.com", "thai", 88, 1, 0, 1, 1, 0, 0),
    ("pizza", "pizzapalace.com", "pizza", 89, 1, 0, 1, 1, 0, 0),
    ("tacos near me", "tacosbymax.com", "tacos", 90, 1, 0, 1, 0, 0, 1),
    ("tacos", "tacosbymax.com", "taco", 88, 1, 0, 1, 1, 0, 0),
    ("fries near me", "friesandmore.com", "fries", 88, 1, 0, 1, 1, 0, 0),
    ("fries", "friesandmore.com", "frie", 86, 1, 0, 1, 0, 0, 1),
    ("x", "xfood.com", "x", 76, 1, 0, 1, 1, 0, 0),
    ("a pizza place", "amore.com", "a pizza place", 42, 0, 0, 1, 0, 0, 1),
    ("smash burger", "smashsd.com", "smash burger", 82, 0, 0, 1, 1, 0, 0),
    ("smashed", "smashsd.com", "smashed", 94, 0, 0, 0, 0, 0, 1),
    ("flavorful curry", "flavorsofindia.com", "flavorful curry", 65, 0, 0, 0, 1, 0, 0),
    ("flavors of india", "flavorsofindia.com", "flavors of india", 97, 1, 1, 1, 0, 0, 1),
    ("mediterranean", "mediterraneangrill.com", "mediterranean", 94, 1, 0, 1, 1, 1, 1),
    ("my pie", "pizzayourway.com", "my pie", 47, 0, 0, 0, 0, 1, 1),
    ("tacos and beer vegas", "tbmx1.com", "tacos and beer vega", 41, 0, 0, 0, 0, 1, 1),
    ("aarus", "aaruz.com", "aaru", 96, 1, 0, 1, 0, 0, 1),
    ("aarus indian", "aaruz.com", "aarus indian", 82, 0, 0, 0, 0, 1, 1),
    ("pepz stadium", "stadiumpepz.com", "pepz stadium", 63, 0, 1, 0, 0, 1, 1),
    ("threes", "3happinessomaha.com", "three", 51, 0, 0, 0, 0, 1, 1),
    ("dialogue cafe la", "dialogcafe.com", "dialogue cafe la", 88, 0, 0, 0, 0, 1, 1),
    ("best delivery pizza chicago", "bestpizza.com", "best pizza chicago", 90, 1, 1, 1, 0, 0, 1),
    ("Pizza Dados", "dadospizzaok.com", "izza ado", 54, 0, 1, 0, 0, 0, 1),
    ("sushi downtown", "dadospizzaok.com", "sushi downtown", 45, 0, 0, 0, 0, 0, 0),
    ("pizza dados near me", "dadospizzaok.com", "pizza dados", 67, 0, 0, 0, 0, 0, 0),
    ("joe's menu", "joes.com", "joes", 100, 1, 0, 1, 0, 0, 1),
    ("a & r tacos", "tacosaandr.com", "a r taco", 57, 0, 0, 0, 0, 1, 1),
    ("big bowl", "big-bowl.com", "big bowl", 100, 0, 1, 1, 0, 0, 1),
    ("bowl", "big-bowl.com", "bowl", 45, 1, 0, 0, 0, 0, 1),
    ("indian in seattle taste", "tasteofindia.com", "indian in seattle taste", 56, 0, 0, 0, 0, 0, 0),
    ("anything", "nodotdomain", "anything", 62, 0, 0, 0, 0, 0, 0),
    ("the delaware pub", "delawarepubandgrill.com", "the delaware pub", 63, 0, 1, 0, 0, 1, 1),
    ("", "foo.com", "", 0, 1, 0, 1, 1, 0, 0),
    ("café menú", "cafe.com", "caf men", 90, 0, 0, 1, 0, 0, 1),
]
