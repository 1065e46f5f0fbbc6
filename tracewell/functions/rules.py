"""Rule packs as data. Patterns, spellings, terms and kinds decide what is found."""

from __future__ import annotations

#: (kind, pattern, flags, canonical form: keep, upper or lower), in order.
PATTERNS = [
    ("device", r"\b(?:Redmi\s+Note\s+\d+(?:\s+Pro|\s+Plus)?|Redmi\s+\d+[A-Za-z]*|Xiaomi\s+Mi\s+Pad\s+\d(?:\s+Plus)?|Xiaomi\s+13T(?:\s+Pro)?)\b", "i", "keep"),
    ("device", r"\bPoco\s+[A-Z]\d{1,3}[A-Z]*(?:\s+(?:Pro|Plus|GT|5G|NFC))?\b", "i", "keep"),
    ("device_model", r"\b\d{4}[A-Z]{2,}\d{2}[A-Z]\b", "i", "upper"),
    ("firmware_version", r"\bV\d+(?:\.\d+){2,}(?:\.[A-Z0-9]+)?\b", "i", "upper"),
    ("firmware_version", r"\bHyperOS\s+\d+(?:\.\d+){1,5}\b", "i", "keep"),
    ("firmware_version", r"\bOS\d+(?:\.\d+){2,5}\b", "i", "upper"),
    ("build_id", r"\b[A-Z]{2,}[A-Z0-9]{2,}(?:\.[A-Z0-9]+){2,}\b", "", "upper"),
]
#: (kind, spelling in lower case, name), in order.
WORDS = [
    *(("firmware_family", w, n) for w, n in (("miui", "MIUI"), ("hyperos", "HyperOS"))),
    *(("tool", w, n) for w, n in (("adb", "ADB"), ("fastboot", "fastboot"), ("kernelsu", "KSU"), ("ksu", "KSU"), ("kernel su", "KSU"), ("magisk", "Magisk"), ("miflash", "MiFlash"), ("orange fox", "OrangeFox"), ("orangefox", "OrangeFox"), ("twrp", "TWRP"))),
    *(("codename", w, w) for w in ("aristotle", "camellia", "clover", "mojito", "sweet", "sunny")),
]
FILES = [(r"\b[\w.-]+\.(?:img|zip|apk|bin|tar|tgz|xz)\b", "i"), (r"\b(?:boot|init_boot|vendor_boot|recovery|dtbo|vbmeta|super)(?:-[a-z0-9_]+)?\.img\b", "i")]
ISSUES = [("issue", "bootloop", "bootloop"), ("issue", "бутлуп", "bootloop"), ("issue", "кирпич", "brick"), ("issue", "brick", "brick")]
RESTORE, FLASH = r"\b(?:restore|восстанов(?:ить|и|ление)|верн(?:уть|и))\b[^.?!]{0,80}", r"\b(?:flash|прош(?:ить|ей|ивка))\b[^.?!]{0,80}"
PATCHED, ROOT_TOOL = r"(?:patch|patched|патч(?:ить|енный)?|пропатч(?:ить|енный)?)", r"(?:magisk|ksu|kernel\s*su)"
FLASHED, RECOVERY_TOOL = r"(?:flash|прош(?:ить|ей|ивается|ивка))", r"(?:fastboot|twrp|orange\s*fox|orangefox)"
ROOT_FAILS = rf"\b{ROOT_TOOL}\b[^.?!]{{0,80}}(?:не\s+могу|не\s+получается|не\s+работ|cannot|can't|cant|not\s+working)"
WARNS = r"(?:не\s+ставить|do\s+not\s+install|warning).{0,160}"
ROOT_FILES = ["boot.img", "init_boot.img"]

FIRMWARE = ["firmware_family", "firmware_version", "build_id"]
#: Relations within a post: (kind, from, to kinds, what the pair must fulfil, confidence). in: the to value is part of the from value.
RELATIONS = [
    ("fixes_issue", "fix", ["issue"], "", 0.45),
    ("warns_about", "warning", ["file", "codename", "device", *FIRMWARE], "in", 0.45),
    ("root_targets_file", "root_action", ["file"], "in", 0.5),
    ("root_uses_tool", "root_action", ["tool"], ["Magisk", "KSU"], 0.45),
    ("root_mentions_firmware", "root_action", FIRMWARE, "", 0.35),
    ("recovery_targets_file", "recovery_action", ["file"], "in", 0.5),
    ("recovery_uses_tool", "recovery_action", ["tool"], ["fastboot", "TWRP", "OrangeFox"], 0.45),
    ("recovery_mentions_firmware", "recovery_action", FIRMWARE, "", 0.35),
]

WARNING_TERMS = ["danger", "do not", "don't", "not safe", "risk", "warning", "важно", "кирпич", "нельзя", "не ставить", "не шить", "не прошивать", "опасно", "осторожно", "риск"]
UPDATE_TERMS = ["after update", "current", "latest", "new build", "no longer", "now", "since update", "works now", "актуально", "новая", "новой", "обновления", "после обнов", "сейчас", "теперь"]
NEGATIVE_TERMS = ["no longer", "not work", "doesn't work", "не работает", "перестал", "перестала", "перестало"]
REVIEW_TERMS = ["maybe", "probably", "unknown", "возможно", "кажется", "не уверен", "под вопросом"]
