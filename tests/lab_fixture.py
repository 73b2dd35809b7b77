"""Three small studies as landed files, with the cohort rows and near misses of the golden queries."""

import json
from pathlib import Path
from xml.sax.saxutils import escape

STUDIES = ("study1", "study2", "study3")


def field(key, label, type_="textfield", **more):
    return {"key": key, "label": label, "type": type_, **more}


def options(*pairs):
    return [{"label": a, "value": b} for a, b in pairs]


PROJECT_FORM = {
    "components": [
        {
            "title": "Project Form",
            "components": [
                field(
                    "form-project", "Project", "container",
                    components=[
                        field("institute", "Institute", validate={"required": True}),
                        field("grant", "Grant ID", conditional={"when": "institute", "eq": "any", "show": True}),
                        field(
                            "devices", "Devices", "datagrid", multiple=True,
                            components=[
                                field(
                                    "type", "Type", "select",
                                    data={"values": options(("Intracranial", "intercranial_sensor"), ("MEG", "meg_sensor"))},
                                )
                            ],
                        ),
                        {"type": "columns", "columns": [{"components": [field("stimuli", "Stimuli")]}]},
                        field("responses", "Responses", description="how subjects answer"),
                    ],
                )
            ],
        }
    ]
}
SUBJECT_FORM = {
    "components": [
        {
            "title": "Subject Form",
            "components": [
                field(
                    "form-subject", "Subject", "container",
                    components=[
                        field("gender", "Gender", "radio", values=options(("Male", "male"), ("Female", "female"))),
                        field("language", "Primary Language"),
                        field("music", "Musical Training", "radio", values=options(("Yes", "yes"), ("No", "no"))),
                        field("eye", "Eye Dominance", "select", data={"values": options(("R", "right"), ("L", "left"))}),
                        field("history", "Psychiatric History"),
                        field("race", "Race"),
                        field("hobbies", "Hobbies", "selectboxes", values=options(("Chess", "chess"), ("Golf", "golf"))),
                        field("extra", "Extra", "datamap"),
                    ],
                )
            ],
        }
    ]
}
SESSION_FORM = {
    "components": [
        {
            "title": "Session Form",
            "components": [
                field(
                    "form-session", "Session", "container",
                    components=[
                        field(
                            "steps", "Steps", "editgrid", components=[field("step", "Analysis Steps")]
                        )
                    ],
                )
            ],
        }
    ]
}
TYPES = {
    "ECOG": "edf:ecogSessionData",
    "ET": "et:eyetrackerSessionData",
    "MEEG": "fif:megEegSessionData",
    "MR": "xnat:mrSessionData",
}


def project_answers(institute, grant, sensor):
    return {
        "form-project": {
            "institute": institute, "grant": grant, "devices": [{"type": sensor}],
            "stimuli": "VisualStims", "responses": "Speech, ButtonPress",
        }
    }


PROJECTS = {
    "study1": project_answers("University of Birmingham", "TWCF0389", "intercranial_sensor"),
    "study2": project_answers("Peking University", None, "intercranial_sensor"),
    "study3": project_answers("University of Birmingham", None, "meg_sensor"),
}


def subject_answers(gender="female", language="English", music="no", eye="left", history="", race="white", **more):
    return {
        "form-subject": {
            "gender": gender, "language": language, "music": music, "eye": eye, "history": history, "race": race,
            "hobbies": {"chess": True, "golf": False}, "extra": {"shoe size": 43}, **more,
        }
    }


SUBJECTS = {
    ("study1", "NA001"): subject_answers(eye="right", race="asian", history="none, then depression"),
    ("study1", "NA002"): subject_answers(eye="right", history="depression, mild"),
    ("study2", "NB001"): subject_answers(gender="male", language="Afrikaans", music="no"),
    ("study2", "NB002"): subject_answers(gender="male", language="Afrikaans", music="yes"),
    ("study3", "NC001"): subject_answers(gender="male", language="Zulu", music="yes", eye="right", race="asian"),
}


def steps(*names):
    return {"form-session": {"steps": [{"step": n} for n in names]}}


SESSIONS = {  # (study, subject, modality) -> answers
    ("study1", "NA001", "MEEG"): steps("raw"),
    ("study1", "NA002", "ET"): steps(),
    ("study2", "NB001", "ECOG"): steps("preprocessing of signals"),
    ("study2", "NB002", "ECOG"): steps("import", "some preprocessing"),
    ("study2", "NB002", "MR"): {},
    ("study3", "NC001", "MEEG"): steps("raw"),
}
SCANS = {  # (study, subject, modality) -> [(scan id, description, manufacturer, model)]
    ("study1", "NA001", "MEEG"): [("Task1", "visual task", "Elekta", "Triux")],
    ("study1", "NA002", "ET"): [("Gaze", "", "SR", None)],
    ("study2", "NB001", "ECOG"): [("FingerLoc", "finger localiser", "Natus", None)],
    ("study2", "NB002", "ECOG"): [("FingerLoc", "finger localiser", "Natus", None), ("Rest", "rest", None, None)],
    ("study2", "NB002", "MR"): [("FingerLoc", "", "Siemens", "Prisma")],
    ("study3", "NC001", "MEEG"): [("Task1", "visual task", "Elekta", "Triux")],
}
HEADERS = {
    "MEEG": {"study1": {"powerLineFrequency": "50"}, "study3": {"powerLineFrequency": "60"}},
    "ET": {"study1": {"Manufacturer": "EYELINK"}},
    "ECOG": {"study2": {"Manufacturer": "NATUS & Co"}},
}


def session_label(subject, modality):
    return f"{subject}_{modality}_1"


def _lines(path: Path, rows):
    path.mkdir(parents=True)
    (path / "part.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))


def land(root: Path, scans=SCANS, subjects=SUBJECTS) -> str:
    for folder in ("projects", "subjects"):
        (root / folder).mkdir(parents=True)
    ns = 'xmlns:xnat="http://example.org/xnat"'
    for i, (study, answers) in enumerate(PROJECTS.items()):
        (root / "projects" / f"{study}.xml").write_text(
            f'<xnat:Project ID="{study}" active="1" {ns}>\n<xnat:name>Title {i} &amp; more</xnat:name>\n'
            f"<xnat:description>About {study}</xnat:description>\n"
            f"<xnat:custom_fields>{escape(json.dumps(answers))}</xnat:custom_fields>\n</xnat:Project>\n"
        )
    for (study, subject), answers in subjects.items():
        (root / "subjects" / f"{subject}.xml").write_text(
            f'<xnat:Subject label="{subject}" project="{study}" {ns}>\n'
            f"<xnat:custom_fields>{escape(json.dumps(answers))}</xnat:custom_fields>\n</xnat:Subject>\n"
        )
    sessions, scan_rows, dicom, fields = [], [], [], []
    for (study, subject, modality), answers in SESSIONS.items():
        type_ = TYPES[modality]
        low = type_.lower()
        label = session_label(subject, modality)
        base = {
            "subject_label": subject, "ID": f"ACC_{label}", f"{low}/label": label, f"{low}/date": "2022-05-01",
            f"{low}/time": "10:20:30",
        }
        sessions.append(
            {"project": study, "session_type": type_, "body": [{**base, f"{low}/custom_fields": json.dumps(answers)}]}
        )
        for scan, description, maker, model in scans[(study, subject, modality)]:
            s = {
                **base, "id": scan, "type": "T", "modality": modality, "meta/insert_date": "2022-05-02 00:00:00",
                "meta/last_modified": "2022-05-03 00:00:00", "start_date": "2022-05-01", "starttime": "10:30:00",
                "quality": "usable", "scanner/manufacturer": maker or "", "scanner/model": model or "",
                "series_description": description,
            }
            record = {
                (k if k in base else f"xnat:imagescandata/{k}"): v for k, v in s.items()
            }
            scan_rows.append({"project": study, "session_type": type_, "body": [record]})
            if modality == "MR":
                dump = [
                    {"tag1": "(0008,0060)", "desc": "Modality", "value": "MR"},
                    {"tag1": "(0009,0010)", "desc": "?", "value": "x"},
                    {"tag1": "(0008,0070)", "desc": "Modality", "value": "MR2"},
                ]
                dicom.append(
                    {"project": study, "session_id": label, "acquisition_id": scan, "body": {"ResultSet": {"Result": dump}}}
                )
            else:
                data = {f"parameters/bids_{k}": v.replace("&", "&amp;") for k, v in HEADERS[modality].get(study, {}).items()}
                data.update({"parameters/gnmd_Lab": "B1", "quality": "usable"})
                fields.append(
                    {
                        "project": study, "subject_id": subject, "session_id": label, "acquisition_id": scan,
                        "body": {"items": [{"data_fields": data}]},
                    }
                )
    sessions.append({"project": "study1", "session_type": "xnat:imageSessionData", "body": [{"ID": "umbrella"}]})
    _lines(root / "sessions", sessions)
    _lines(root / "scans", scan_rows)
    _lines(root / "dicom", dicom)
    _lines(root / "fields", fields)
    forms = []
    for study in STUDIES:
        forms.append({"project": study, "xnat_data_type": "xnat:projectData", "body": PROJECT_FORM})
        forms.append({"project": study, "xnat_data_type": "xnat:subjectData", "body": SUBJECT_FORM})
        for modality in ("ECOG", "MEEG", "ET"):
            forms.append({"project": study, "xnat_data_type": TYPES[modality], "body": SESSION_FORM})
    _lines(root / "forms", forms)
    return str(root)
