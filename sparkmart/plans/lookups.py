"""Code labels and the two static lookup dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "approved", "created",
)

PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

# key, name, category, sort order, source value
ORDER_STATUS_ROWS = (
    (-1, "UNKNOWN", "UNKNOWN", 0, None),
    (1, "Created", "In Progress", 1, "created"),
    (2, "Approved", "In Progress", 2, "approved"),
    (3, "Invoiced", "In Progress", 3, "invoiced"),
    (4, "Processing", "In Progress", 4, "processing"),
    (5, "Shipped", "In Progress", 5, "shipped"),
    (6, "Delivered", "Completed", 6, "delivered"),
    (7, "Canceled", "Canceled", 7, "canceled"),
    (8, "Unavailable", "Canceled", 8, "unavailable"),
)

# key, name, source value
PAYMENT_TYPE_ROWS = (
    (-1, "UNKNOWN", None),
    (1, "Credit Card", "credit_card"),
    (2, "Boleto", "boleto"),
    (3, "Voucher", "voucher"),
    (4, "Debit Card", "debit_card"),
    (5, "Not Defined", "not_defined"),
)

STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AM": "Amazonas",
    "AP": "Amapá",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MG": "Minas Gerais",
    "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso",
    "PA": "Pará",
    "PB": "Paraíba",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "PR": "Paraná",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RO": "Rondônia",
    "RR": "Roraima",
    "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina",
    "SE": "Sergipe",
    "SP": "São Paulo",
    "TO": "Tocantins",
}

CATEGORY_LABELS = {
    "agro_industry_and_commerce": "Agro Industry & Commerce",
    "air_conditioning": "Air Conditioning",
    "art": "Art",
    "arts_and_craftmanship": "Arts & Craftsmanship",
    "audio": "Audio",
    "auto": "Auto",
    "baby": "Baby",
    "bed_bath_table": "Bed, Bath & Table",
    "books_general_interest": "Books: General Interest",
    "books_imported": "Books: Imported",
    "books_technical": "Books: Technical",
    "cds_dvds_musicals": "CDs, DVDs & Musicals",
    "christmas_supplies": "Christmas Supplies",
    "cine_photo": "Cinema & Photo",
    "computers": "Computers",
    "computers_accessories": "Computers & Accessories",
    "consoles_games": "Consoles & Games",
    "construction_tools_construction": "Construction Tools",
    "construction_tools_lights": "Construction: Lights",
    "construction_tools_safety": "Construction: Safety",
    "cool_stuff": "Cool Stuff",
    "costruction_tools_garden": "Construction: Garden",
    "costruction_tools_tools": "Construction: General",
    "diapers_and_hygiene": "Diapers & Hygiene",
    "drinks": "Drinks",
    "dvds_blu_ray": "DVDs & Blu-Ray",
    "electronics": "Electronics",
    "fashio_female_clothing": "Fashion: Female Clothing",
    "fashion_bags_accessories": "Fashion: Bags",
    "fashion_childrens_clothes": "Fashion: Children",
    "fashion_male_clothing": "Fashion: Male Clothing",
    "fashion_shoes": "Fashion: Shoes",
    "fashion_sport": "Fashion: Sport",
    "fashion_underwear_beach": "Fashion: Underwear",
    "fixed_telephony": "Fixed Telephony",
    "flowers": "Flowers",
    "food": "Food",
    "food_drink": "Food & Drink",
    "furniture_bedroom": "Furniture: Bedroom",
    "furniture_decor": "Furniture & Decor",
    "furniture_living_room": "Furniture: Living Room",
    "furniture_mattress_and_upholstery": "Furniture: Mattress",
    "garden_tools": "Garden Tools",
    "health_beauty": "Health & Beauty",
    "home_appliances": "Home Appliances",
    "home_appliances_2": "Home Appliances II",
    "home_comfort_2": "Home Comfort II",
    "home_confort": "Home Comfort",
    "home_construction": "Home Construction",
    "housewares": "Housewares",
    "industry_commerce_and_business": "Industry & Commerce",
    "kitchen_dining_laundry_garden_furniture": "Furniture: Kitchen & Dining",
    "la_cuisine": "La Cuisine",
    "luggage_accessories": "Luggage & Accessories",
    "market_place": "Marketplace",
    "music": "Music",
    "musical_instruments": "Musical Instruments",
    "office_furniture": "Office Furniture",
    "party_supplies": "Party Supplies",
    "pc_gamer": "PC Gaming",
    "pc_gaming": "PC Gaming",
    "perfumery": "Perfumery",
    "pet_shop": "Pet Shop",
    "portable_kitchen_and_food_processors": "Portable Kitchen",
    "portateis_cozinha_e_preparadores_de_alimentos": "Portable Kitchen",
    "security_and_services": "Security & Services",
    "signaling_and_security": "Signaling & Security",
    "small_appliances": "Small Appliances",
    "small_appliances_home_oven_and_coffee": "Small Appliances: Oven",
    "sports_leisure": "Sports & Leisure",
    "stationery": "Stationery",
    "tablets_printing_image": "Tablets & Printing",
    "telephony": "Telephony",
    "toys": "Toys",
    "watches_gifts": "Watches & Gifts",
}


def order_status_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(ORDER_STATUS_ROWS),
        "order_status_key int, status_name string, status_category string, sort_order short, source_value string",
    )


def payment_type_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PAYMENT_TYPE_ROWS), "payment_type_key int, payment_type_name string, source_value string"
    )
