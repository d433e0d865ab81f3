"""A short table of simplified and traditional characters, the default where no fuller one is passed."""

from __future__ import annotations

#: Common characters of written Mandarin that differ between the scripts, in pairs of equal place; none of the first is in traditional use.
SIMPLIFIED = "这来时个们国说对会过还没问样关让觉见听话语认识观变应该动脑脸颈头发声边东车长门马鸟鱼风飞书画学习实现为从众伤体条件价值紧张情绪乐愿乡亲爱兴奋惊讶恐惧愤怒厌恶轻轻缓慢顺势转动战场权威骗谎谁请谢"
TRADITIONAL = "這來時個們國說對會過還沒問樣關讓覺見聽話語認識觀變應該動腦臉頸頭發聲邊東車長門馬鳥魚風飛書畫學習實現為從眾傷體條件價值緊張情緒樂願鄉親愛興奮驚訝恐懼憤怒厭惡輕輕緩慢順勢轉動戰場權威騙謊誰請謝"

#: The pairs that differ, each once, as two strings for ``translate``.
PAIRS = dict((s, t) for s, t in zip(SIMPLIFIED, TRADITIONAL, strict=True) if s != t)
SIMPLIFIED_ONLY = "".join(PAIRS)
TO_TRADITIONAL = (SIMPLIFIED_ONLY, "".join(PAIRS.values()))
