"""Fixed catalogs: platforms, url rules, labels, outcomes and thresholds, and their small dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Hosts of each platform.
HOSTS: dict[str, tuple[str, ...]] = {
    "facebook": ("facebook.com", "fb.com", "fb.watch", "m.facebook.com", "web.facebook.com"),
    "youtube": ("youtube.com", "youtu.be", "m.youtube.com", "music.youtube.com", "youtube-nocookie.com"),
    "tiktok": ("tiktok.com", "vm.tiktok.com", "vt.tiktok.com", "m.tiktok.com"),
    "instagram": ("instagram.com", "instagr.am", "www.instagram.com"),
    "x": ("x.com", "twitter.com", "mobile.twitter.com", "mobile.x.com"),
    "reddit": ("reddit.com", "old.reddit.com", "new.reddit.com", "redd.it", "v.redd.it"),
    "vimeo": ("vimeo.com", "player.vimeo.com"),
    "dailymotion": ("dailymotion.com", "dai.ly", "www.dailymotion.com"),
}
# Fixed values: (platform, pattern with the id as its group, object type, short link), the first that fits counts.
URL_RULES: tuple[tuple[str, str, str, bool], ...] = (
    ("facebook", r"/reel/(\d+)", "reel", False),
    ("facebook", r"/share/r/([A-Za-z0-9_\-]+)", "reel", True),
    ("facebook", r"[?&]v=(\d+)", "video", False),
    ("facebook", r"/videos/(\d+)", "video", False),
    ("facebook", r"/share/v/([A-Za-z0-9_\-]+)", "video", True),
    ("facebook", r"fb\.watch/([A-Za-z0-9_\-]+)", "video", True),
    ("facebook", r"story_fbid=(\d+)", "post", False),
    ("facebook", r"[?&]fbid=(\d+)", "photo", False),
    ("facebook", r"/photos?/(\d+)", "photo", False),
    ("youtube", r"/shorts/([A-Za-z0-9_\-]{11})", "short", False),
    ("youtube", r"[?&]v=([A-Za-z0-9_\-]{11})", "video", False),
    ("youtube", r"youtu\.be/([A-Za-z0-9_\-]{11})", "video", False),
    ("youtube", r"/embed/([A-Za-z0-9_\-]{11})", "video", False),
    ("youtube", r"/live/([A-Za-z0-9_\-]{11})", "video", False),
    ("tiktok", r"/@[^/]+/video/(\d+)", "video", False),
    ("tiktok", r"/@[^/]+/photo/(\d+)", "photo", False),
    ("tiktok", r"/v/(\d+)", "video", False),
    ("tiktok", r"vm\.tiktok\.com/([A-Za-z0-9]+)", "video", True),
    ("tiktok", r"vt\.tiktok\.com/([A-Za-z0-9]+)", "video", True),
    ("tiktok", r"/t/([A-Za-z0-9]+)", "video", True),
    ("instagram", r"/reels?/([A-Za-z0-9_\-]+)", "reel", False),
    ("instagram", r"/tv/([A-Za-z0-9_\-]+)", "video", False),
    ("instagram", r"/stories/[^/]+/(\d+)", "story", False),
    ("instagram", r"/p/([A-Za-z0-9_\-]+)", "post", False),
    ("x", r"/i/status/(\d+)", "post", False),
    ("x", r"/status(?:es)?/(\d+)", "post", False),
    ("reddit", r"v\.redd\.it/([A-Za-z0-9]+)", "video", False),
    ("reddit", r"/r/[^/]+/comments/([a-z0-9]+)", "post", False),
    ("reddit", r"/comments/([a-z0-9]+)", "post", False),
    ("reddit", r"redd\.it/([a-z0-9]+)", "post", True),
    ("vimeo", r"/video/(\d+)", "video", False),
    ("vimeo", r"vimeo\.com/(\d+)", "video", False),
    ("dailymotion", r"/video/([A-Za-z0-9]+)", "video", False),
    ("dailymotion", r"dai\.ly/([A-Za-z0-9]+)", "video", True),
)
# What a page says that found nothing, and one whose video is gone (lower-cased).
NO_RESULT_MARKERS = ("we couldn't find", "couldn't find anything", "aucun résultat", "nous n'avons trouvé")
REMOVED_MARKERS = ("không còn nữa", "đã bị gỡ", "liên kết bị hỏng", "isn't available", "no longer available", "content isn", "video unavailable")
# Links to a video among a page's links, and to a group.
VIDEO_LINKS = (r"facebook\.com/watch\?", r"facebook\.com/reel/", r"facebook\.com/share/v/", r"facebook\.com/.+/videos/\d+", r"story_fbid=\d+")
GROUP_LINK = r"facebook\.com/groups/[\w.\-]+$"
# Colours of labels in annotations.
LABEL_COLOURS = {
    "Abuse": "#ffaaff", "Arrest": "#55aaff", "Arson": "#aaffff",
    "Explosion": "#ffaa00", "Fighting": "#ffaaaa", "Normal": "#aaffaa",
    "RoadAccident": "#ffffaa", "Robbery": "#28ffff", "Vandalism": "#00ff7f",
    "ArmedFight": "#ff7f7f", "ArmedSuspect": "#ff5500", "Burglary": "#aa88ff",
    "CarTheft": "#ffd27f", "Collapse": "#c8a07d", "GunRobber": "#ff557f",
    "KnifeRobber": "#d07fff", "MotorTheft": "#7fbfff", "Shooting": "#ff0000",
    "Smoke": "#b4b4b4", "Stealing": "#7fffd4", "Unconscious": "#ffb6c1",
    "Drowning": "#5f9fff", "PourPetrol": "#e0c000", "Riot": "#ff8c69",
    "ShootDown": "#c04040", "Stampede": "#9acd32", "Snatching": "#40e0d0",
}
COLOUR_ELSE = "#cccccc"
# What marks a recorder's file.
RECORDER_SUFFIXES = (".dav", ".264", ".h264", ".265", ".h265")
RECORDER_TAGS = r"hikvision|dahua|dhav|uniview|ezviz|imou|kbvision|surveillance|\bnvr\b|\bdvr\b"
# Times of day and dates as they stand in a picture.
CLOCK_FORM = r"(?<!\d)((?:[01]?\d|2[0-3])[:.][0-5]\d[:.][0-5]\d)(?!\d)"
DATE_FORM = r"(?<!\d)(\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})(?!\d)"
# Where the id of a video stands in its page's url, the first that fits counts.
VIDEO_ID_FORMS = (r"/videos/(\d+)", r"[?&]v=(\d+)", r"/reel/(\d+)", r"[/=](\d{8,})")
# Dataset labels and how they are displayed, in order.
LABELS: tuple[tuple[str, str], ...] = (
    ("Abuse", "Abuse"), ("Arrest", "Arrest"), ("Arson", "Arson"), ("Explosion", "Explosion"),
    ("Fighting", "Fighting"), ("RoadAccident", "RoadAccident"), ("Vandalism", "Vandalism"),
    ("Robbery", "Robbery"), ("Shooting", "Shooting"), ("ArmedSuspect", "Armed suspect"),
    ("Burglary", "Burglary"), ("Collapse", "Collapse"), ("Drowning", "To drown"),
    ("ArmedFight", "Armed fight"), ("CarTheft", "Car theft"), ("MotorTheft", "Motor theft"),
    ("Normal", "Normal"), ("PourPetrol", "Pour petrol"), ("Riot", "Riot"),
    ("GunRobber", "Gun-toting robber"), ("KnifeRobber", "Knife-wielding robber"),
    ("ShootDown", "Shoot down"), ("Smoke", "Smok"), ("Stampede", "Stampede"),
    ("Stealing", "Stealing"), ("Snatching", "Snatching"), ("Unconscious", "Unconscious"),
)
# Outcome -> stored status; terminal statuses; outcome -> group of reject actions.
STATUS = {
    "downloaded": "downloaded", "dup_l1": "skipped_duplicate", "dup_l2": "skipped_duplicate",
    "dup_l3": "skipped_duplicate", "dup_l4": "skipped_duplicate", "not_cctv": "skipped_not_cctv",
    "portrait": "skipped_not_cctv", "no_valid_frame": "skipped_not_cctv", "uncertain_cctv": "skipped_not_cctv",
    "no_event": "skipped_no_event", "failed": "failed", "error": "failed",
}
TERMINAL = ("downloaded", "skipped_duplicate", "skipped_not_cctv", "skipped_no_event")
REJECT_GROUP = {
    "portrait": "portrait", "dup_l2": "dedup", "dup_l3": "dedup", "dup_l4": "dedup",
    "not_cctv": "cctv", "uncertain_cctv": "cctv", "no_valid_frame": "cctv", "no_event": "videomae",
}
# Terms that mark a title as entertainment.
TITLE_BLOCKLIST = (
    "music", "nhạc", "documentary", "compilation", "relaxing", "relax", "asmr", "sleep", "meditation", "lo-fi",
    "lofi", "top 10", "best of", "movie", "trailer", "gameplay", "vlog", "review", "reaction", "podcast",
    "tutorial", "highlights", "concert", "dj set",
)
# Tags too general to search for.
GENERIC_TAGS = (
    "viral", "fyp", "foryou", "foryoupage", "trending", "video", "videos", "news", "crime", "cctv", "camera",
    "police", "shorts", "reels", "reel", "funny", "wtf", "omg", "life", "story", "clip", "tiktok", "instagram",
    "accident", "fight", "theft", "robbery", "shooting", "fire",
)
# Plate forms; the sixth stands for the form as it works, with its braces taken literally.
PLATE_FORMS = (
    r"^[1-9][0-9][A-Z][0-9]{3,5}$", r"^[1-9][0-9][A-Z][1-9][0-9]{3,5}$", r"^[1-9][0-9][A-Z]{2}[0-9]{3,5}$",
    r"^[1-9][0-9](NG|QT|CV|NN)[0-9]{5}$", r"^[1-9][0-9]{3}(NG|QT|CV|NN)[0-9]{2}$",
    r"^[A-Z]\{2-3\}[0-9]{4}$", r"^[A-Z]{2}[0-9]{3}[A-Z]{2}$",
)
PLATE_FORM_MEANT = r"^[A-Z]{2,3}[0-9]{4}$"
# Which of two overlapping detections stays.
CLASS_PRIORITY = {"smart phone": 3, "Helmet": 3, "Hat": 3, "Hood": 3, "Head": 2, "goods carried on a motorbike": 1}
# Class groups a frame is saved for.
HELMET_GROUPS = ((0,), (1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))
# Thresholds.
L3_BELOW, L4_MEAN_BELOW, DURATION_SHARE = 8, 10, 0.20
CROSS_DISTANCE, CROSS_FRAMES, LOW_EDGE = 6, 2, 5.0
FRAME_POSITIONS = (0.1, 0.3, 0.5, 0.7, 0.9)
HI, LO, MIN_SECONDS = 0.7, 0.3, 2.0
CUT_LEVEL, MIN_SHOT_S, MERGE_GAP_S = 27.0, 0.5, 0.5
STREAK_LIMIT, BACKOFF_HOURS, BACKOFF_MAX_HOURS = 3, 6, 48
RETRY_FIRST_S, RETRY_MOST_S = 600, 43_200
MAX_DURATION, MAX_DURATION_DEFAULT = {"dailymotion": 900}, 1800


def label_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(LABELS)], "ord int, label string, display string")


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, i, r, t, s) for i, (p, r, t, s) in enumerate(URL_RULES)], "platform string, rule_no int, pattern string, object_type string, is_short boolean")


def host_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, h) for p, hs in HOSTS.items() for h in hs], "platform string, host string")
