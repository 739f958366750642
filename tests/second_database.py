"""A hand-written second database: five admissions, times in epoch milliseconds."""

from wardline.sources.schemas import second_database

START = 1_000_000_000


def ms(minutes):
    return int(START + minutes * 60_000)


def tables(spark):
    data = {name: [] for name in second_database()}

    def add(name, *values):
        data[name].append(values)

    # 1: non-rebreather from minute 10, intubated at 2000. 2: second admission of the same person.
    # 3: operative. 4: non-invasive support, dies, no intubation. 5: tracheostomy route later on.
    people = ((1, 70, 1), (2, 70, 2), (3, 71, 1), (4, 72, 1), (5, 73, 1))
    for adm, person, count in people:
        died = ms(3000) if adm == 4 else None
        add("admissions", person, adm, count, START, ms(6000), died, "IC", "1", "Vrouw" if adm == 1 else "Man",
            "60-69", "70-79", "170-179", "Interne", "2003-2009")
    for adm in (1, 2, 3, 5):
        add("listitems", adm, 8189, 17, "Toedieningsweg", "Non-Rebreathing masker", ms(10), "ICV")
        add("numericitems", adm, 8845, 1, "O2 l/min", 15.0, ms(10), "ICV")
    add("numericitems", 4, 12369, 1, "SET %O2", 60.0, ms(30), "ICV")
    add("listitems", 5, 8189, 18, "Toedieningsweg", "Spreekcanule", ms(500), "ICV")
    add("numericitems", 5, 8845, 1, "O2 l/min", 5.0, ms(500), "ICV")
    add("numericitems", 1, 8845, 1, "O2 l/min", 15.0, ms(200), None)
    add("listitems", 1, 8189, 12, "Toedieningsweg", "B.Lucht", ms(200), None)
    add("numericitems", 1, 6699, 1, "FiO2 %", 0.0, ms(250), "ICV")
    add("procedureorderitems", 1, 9476, ms(2000))
    add("processitems", 4, 10740, ms(40))
    add("processitems", 4, 9999, ms(41))
    for adm, item, text in ((1, 18669, "Respiratory failure"), (2, 18669, "Sepsis"), (3, 18671, "Post-operative CABG"),
                            (4, 18671, "Respiratory - sepsis")):
        add("listitems", adm, item, 1, "APACHE", text, ms(5), "ICV")
    add("listitems", 4, 8000, 2, "Beleid", "Niet reanimeren", ms(60), "ICV")
    for adm in (1, 4):
        base = 30 if adm == 4 else 10
        for k, rate in enumerate((28.0, 32.0, 90.0)):
            add("respiratory_rate", adm, base + 20.0 * k, rate, True)
        add("respiratory_rate", adm, base + 5.0, 11.0, False)
        add("coma_score", adm, base + 1.0, 14.0)
        for minute, item, value, who in ((base, 6640, 100.0, "ICV"), (base + 30, 6640, 120.0, "ICV"),
                                         (base + 30, 6709, 91.0, "ICV"), (base, 6709, 95.0 - adm, "ICV"),
                                         (base + 30, 6642, 70.0, None), (base + 31, 6642, 500.0, "ICV")):
            add("numericitems", adm, item, 1, "x", value, ms(minute), who)
    # Gas in kPa with its companions, arterial; a venous one; one of unknown origin, 47 min before.
    add("numericitems", 1, 21214, 152, "PO2", 8.0, ms(20), "Systeem")
    add("numericitems", 1, 21213, 152, "PCO2", 6.0, ms(20), "ICV")
    add("numericitems", 1, 12310, 1, "pH", 7.31, ms(20), "ICV")
    add("freetextitems", 1, 11646, ms(20), "art. rechts")
    add("numericitems", 1, 7433, 1, "PO2", 40.0, ms(25), "ICV")
    add("freetextitems", 1, 11646, ms(25), "ven.")
    add("numericitems", 1, 7433, 1, "PO2", 70.0, ms(-47), "ICV")
    add("numericitems", 1, 7433, 1, "PO2", 71.0, ms(-49), "ICV")
    add("drugitems", 1, 7229, "Noradrenaline (Norepinefrine)", ms(100), ms(300))
    add("drugitems", 1, 6818, "Adrenaline (Epinefrine)", ms(200), ms(400))
    add("drugitems", 1, 9126, "Fenylefrine", ms(50), ms(60))
    schemas = second_database()
    return {n: spark.createDataFrame(data[n], schemas[n]) for n in schemas}
