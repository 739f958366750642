"""A hand-written first database: four stays, one of them with every kind of record."""

from datetime import datetime, timedelta

from wardline.sources.schemas import first_database

IN = datetime(2150, 3, 1, 8, 0, 30)


def at(minutes, seconds=0):
    """A time whose minute number is ``minutes`` after admission's."""
    return datetime(2150, 3, 1, 8, 0, 0) + timedelta(minutes=minutes, seconds=seconds)


def tables(spark):
    data = {name: [] for name in first_database()}

    def add(name, *values):
        data[name].append(values)

    # Stay 1: eligible at minute 60 (device 5 from minute 50, saturation and oxygen at 60),
    # intubated at minute 1000. Stay 2: same subject, later stay, also eligible. Stay 3: planned
    # admission. Stay 4: on high flow, dies unintubated.
    for stay, subject, hadm, seq in ((1, 10, 100, 1), (2, 10, 101, 2), (3, 11, 102, 1), (4, 12, 103, 1)):
        out = at(5000) if stay != 4 else at(9000)
        add("icustays", subject, hadm, stay, IN, out, 3.5)
        add("icustay_detail", stay, hadm, seq, 1, 64.0)
        kind = "ELECTIVE" if stay == 3 else "EW EMER."
        death = at(3000) if stay == 4 else None
        left = "DIED" if stay == 4 else "HOME"
        add("admissions", subject, hadm, kind, left, "ED", "WHITE" if stay == 1 else "ASIAN", "ENGLISH", "Medicare",
            "SINGLE", at(-600), at(6000), death)
        device = {1: "Bipap mask ", 2: "Bipap mask ", 3: "Bipap mask ", 4: "High flow nasal cannula"}[stay]
        add("oxygen_delivery", stay, at(50), device, None, None, None, None)
        add("vitalsign", stay, at(60), 24.0, 92.0)
        add("chartevents", subject, hadm, stay, at(60), 223835, None, 0.8)
        add("transfers", hadm, IN, "Coronary Care Unit (CCU)")
        add("services", hadm, at(-400), "MED")
        add("services", hadm, at(-20), "CMED")
        add("services", hadm, at(30), "SURG")
        add("height", stay, 170.0)
        add("first_day_weight", stay, 80.0)
    for subject, age in ((10, 64), (11, 39), (12, 85)):
        add("patients", subject, 2150, "2014 - 2016", age, "F")
    add("procedureevents", 1, at(1000), 224385)
    # Stay 1: charted fan-out at minute 70: two charted values, one unrelated row, one flow.
    add("chartevents", 10, 100, 1, at(70), 223835, None, 50.0)
    add("chartevents", 10, 100, 1, at(70), 223835, None, 60.0)
    add("chartevents", 10, 100, 1, at(70), 220045, None, 101.0)
    add("oxygen_delivery", 1, at(70), "Face tent", None, None, None, 10.0)
    # An unusable charted value and a percentage typed into the flow field.
    add("chartevents", 10, 100, 1, at(80), 223835, None, 5.0)
    add("oxygen_delivery", 1, at(90), "Nasal cannula", None, None, None, 30.0)
    # A device only in the second slot: kept beside a vital sign, dropped alone.
    add("oxygen_delivery", 1, at(95), None, "Nasal cannula", None, None, None)
    add("oxygen_delivery", 1, at(96), None, "Nasal cannula", None, None, None)
    add("vitalsign", 1, at(96), 22.0, None)
    # Measurements, effort signs, coma score, temperature, labs, gases, urine, procedures.
    for minute, item, value in (
        (40, 220210, 30.0), (40, 220045, 110.0), (100, 220210, 34.0), (100, 220210, 900.0),
        (40, 220739, 4.0), (40, 223900, 5.0), (40, 223901, 6.0), (200, 220739, 3.0), (200, 223901, 6.0),
        (40, 223761, 98.6), (100, 220277, 88.0), (2000, 220210, 20.0), (40, 220179, 120.0),
    ):
        add("chartevents", 10, 100, 1, at(minute), item, None, value)
    add("chartevents", 12, 103, 4, at(62), 220277, None, 95.0)
    add("chartevents", 10, 100, 1, at(40), 223990, "Labored", None)
    add("chartevents", 10, 100, 1, at(40), 229322, "Regular", None)
    add("chartevents", 10, 100, 1, at(45), 228687, "Full code", None)
    for item, value in ((50818, 50.0), (50820, 7.3), (50813, -1.0)):
        add("labevents", 10, at(55), item, value)
    add("bg", 10, at(55), 65.0, "ART.")
    add("bg", 10, at(56), 40.0, "VEN.")
    add("urine_output_rate", 1, at(50), 1.2)
    add("urine_output_rate", 1, at(51), 80.0)
    add("procedureevents", 1, at(58), 225459)
    # Vasopressor handed over between bags at minute 300, stopped at 400; a second drug 350-360.
    add("norepinephrine", 1, at(200), at(300))
    add("norepinephrine", 1, at(300), at(400))
    add("vasopressin", 1, at(350), at(420))
    for text, given in (("Furosemide 40mg", "Administered"), ("Vancomycin", "Started"), ("Torsemide", "Administered"),
                        ("Morphine", "Not Given")):
        add("emar", 100, at(59), text, given)
    for code in ("E119", "E660", "J449"):
        add("diagnoses_icd", 100, code)
    schemas = first_database()
    return {n: spark.createDataFrame(data[n], schemas[n]) for n in schemas}
