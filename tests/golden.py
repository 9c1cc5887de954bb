"""Golden rows. They must equal the established results."""

SALES_ORDERS = """
2 2022-11-03 14:20:52.186 19 8 42972 3.94 2 3 2022-11-07 2022-11-08 8
3 2022-11-03 14:20:52.188 10 4 65839 2.91 3 4 2022-11-06 2022-11-07 19
4 2022-11-03 14:20:52.188 10 16 32069 3.89 2 4 2022-11-05 2022-11-07 15
5 2022-11-03 14:20:52.186 18 4 49659 2.41 3 7 2022-11-05 2022-11-08 25
6 2022-11-04 11:37:10.341 13 18 83908 3.99 3 3 2022-11-04 2022-11-07 17
7 2022-11-04 12:57:09.926 11 10 65453 2.89 2 7 2022-11-04 2022-11-09 28
8 2022-11-04 13:45:10.306 11 20 20381 2.22 2 2 2022-11-06 2022-11-07 8
10 2022-11-07 09:07:10.485 16 12 61620 3.86 2 3 2022-11-09 2022-11-10 20
11 2022-11-07 15:53:10.153 14 12 35227 3.41 2 9 2022-11-08 2022-11-13 13
12 2022-11-09 10:20:09.912 8 12 7693 3.88 2 2 2022-11-13 2022-11-11 15
"""

DATES = [
    ("2022-11-03", 4, "thursday"),
    ("2022-11-04", 5, "friday"),
    ("2022-11-05", 6, "saturday"),
    ("2022-11-06", 7, "sunday"),
    ("2022-11-07", 1, "monday"),
    ("2022-11-08", 2, "tuesday"),
    ("2022-11-09", 3, "wednesday"),
    ("2022-11-10", 4, "thursday"),
    ("2022-11-11", 5, "friday"),
    ("2022-11-13", 7, "sunday"),
]

QUARTERS = {
    "thirds": [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5],
    "calendar": [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4],
}

DESIGNS = [
    (8, "Wooden", "/usr", "wooden-20220717-npgz.json"),
    (51, "Bronze", "/private", "bronze-20221024-4dds.json"),
    (69, "Bronze", "/lost+found", "bronze-20230102-r904.json"),
    (16, "Soft", "/System", "soft-20211001-cjaz.json"),
    (54, "Plastic", "/usr/ports", "plastic-20221206-bw3l.json"),
    (10, "Soft", "/usr/share", "soft-20220201-hzz1.json"),
    (57, "Cotton", "/etc/periodic", "cotton-20220527-vn4b.json"),
    (41, "Granite", "/usr/X11R6", "granite-20220125-ifwa.json"),
    (45, "Frozen", "/Users", "frozen-20221021-bjqs.json"),
    (2, "Steel", "/etc/periodic", "steel-20210725-fcxq.json"),
]

ADDRESSES = [
    (1, "6826 Herzog Via", None, "Avon", "New Patienceburgh", "28441", "Turkey", "1803 637401"),
    (2, "179 Alexie Cliffs", None, None, "Aliso Viejo", "99305-7380", "San Marino", "9621 880720"),
    (3, "148 Sincere Fort", None, None, "Lake Charles", "89360", "Samoa", "0730 783349"),
    (15, "605 Haskell Trafficway", "Axel Freeway", None, "East Bobbie", "88253-4257",
     "Heard Island and McDonald Islands", "9687 937447"),
    (22, "364 Goodwin Streets", None, None, "Sayreville", "85544-4254", "Svalbard & Jan Mayen Islands", "0847 468066"),
    (23, "822 Providenci Spring", None, "Berkshire", "Derekport", "25541", "Papua New Guinea", "4111 801405"),
    (28, "079 Horacio Landing", None, None, "Utica", "93045", "Austria", "7772 084705"),
    (29, "37736 Heathcote Lock", "Noemy Pines", None, "Bartellview", "42400-5199", "Congo", "1684 702261"),
]

# counterparty, its legal address, name
COUNTERPARTIES = [
    (1, 15, "Fahey and Sons"),
    (2, 28, "Leannon, Predovic and Morar"),
    (3, 2, "Armstrong Inc"),
    (4, 29, "Kohler Inc"),
    (5, 22, "Frami, Yundt and Macejkovic"),
    (6, 23, "Mraz LLC"),
]

# staff, first name, last name, department, location
STAFF = [
    (1, "Jeremie", "Franey", "Purchasing", "Manchester"),
    (2, "Deron", "Beier", "Facilities", "Manchester"),
    (3, "Jeanette", "Erdman", "Facilities", "Manchester"),
    (4, "Ana", "Glover", "Production", "Leeds"),
    (5, "Magdalena", "Zieme", "HR", "Leeds"),
]

CURRENCIES = [(1, "GBP", "Great British Pounds"), (2, "USD", "United States Dollars"), (3, "EUR", "Euro")]
