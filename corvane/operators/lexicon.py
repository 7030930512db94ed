"""Word lists of the rule sets (fixed values)."""

# First rule set.
V1_NEGATIVE = ["暂时不需要", "不考虑", "没需要", "不需要", "不愿意", "不可以", "不用", "不要"]
V1_POSITIVE = ["有需要", "可以", "愿意", "考虑", "需要", "要"]

# Third rule set and those built on it.
NEGATIVE = ["不贷款", "不考虑", "不想", "不办", "不缺", "暂时不需要", "没需要", "不需要", "不愿意", "不可以", "不行", "不是", "没有", "没用", "没要", "不用", "不要", "没", "不"]
POSITIVE = ["有需要", "有需求", "想要", "想办", "要用", "好的", "需要", "可以", "考虑", "缺", "要", "是", "有", "好"]
FILLER = ["嗯嗯", "嗯", "啊", "哦", "呃", "额", "唔"]
AFFIRMATION = ["需要", "可以", "是", "有", "好的", "好"]
CRITICAL = ["不需要", "不要", "不用", "没有", "需要", "嗯嗯", "嗯", "啊", "有", "是", "对", "好", "没", "不", "要"]
REJECT = ["滚", "傻逼", "他妈", "去死", "别打电话", "别再打", "别再打电话", "打错了", "骚扰", "骗子", "烦死了", "闭嘴"]

# Families of the first rule set and their route names.
FAMILIES = {"qwen": ["qwen", "qwen1", "qwen2"], "sensevoice": ["sensevoice", "sensevoice1", "sensevoice2"], "doubao": ["doubao", "doubao1", "doubao2"], "kimi": ["kimi", "kimi1", "kimi2"]}
