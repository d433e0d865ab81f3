"""Labelled exemplars of residue: the default of the parameter of ``residue.residue``.

Written from what web servers, browsers, page templates and language runtimes
commonly say; the README says what its author had seen. A deployment passes its
own labelled rows.
A Chinese exemplar stands in both scripts, character by character; the pairs
also say which characters of the two scripts are one.
"""

from __future__ import annotations

from collections.abc import Iterator

#: Labelled exemplars in Latin letters, divided by bars.
LATIN = {
    "notice": """
bad request|unauthorized|forbidden|not found|method not allowed|request timeout|gone|payload too large|too many requests|unavailable for legal reasons|internal server error|not implemented|bad gateway|service unavailable|gateway timeout|unknown error|http error|error code 404|http status 500|request id 0|reference number 0
page not found|this page could not be found|the page you are looking for does not exist|the page you requested has been moved or deleted|sorry we can't find that page|the requested url was not found on this server|the link you followed may be broken|this content is no longer available|this article has been removed|this chapter is not available|the document failed to load|this video is unavailable|the file could not be displayed|the text could not be opened|the address is not valid|the link has expired|we could not load this content
oops something went wrong|an error has occurred while processing your request|an unexpected error occurred|please try again later|please wait and try again in a few minutes|refresh the page and try again|reload this page|retry|go back to the home page|return to the previous page|check the address and try again|you will be redirected in 5 seconds|redirecting|click here if you are not redirected|contact the administrator if the problem persists|our engineers have been notified|we are working on a fix|the site is down for maintenance|scheduled maintenance in progress|we will be back soon|temporarily unavailable|we are sorry for the inconvenience
the server is busy or overloaded|the server did not answer in time|the connection has timed out|connection reset|connection refused|no response from the upstream server|upstream connect error|error establishing a database connection|could not connect to the database|warning undefined variable on line 0|fatal error uncaught exception in php on line 0|parse error unexpected end of json input|unexpected token|traceback most recent call last|file line 0 in module|keyerror|typeerror cannot read properties of undefined|valueerror|attributeerror|nameerror is not defined|indexerror|nullpointerexception|stack trace|out of memory|allowed memory size exhausted|memory limit|object object|undefined|null|nan
access denied|you do not have permission to access this page|you are not allowed to view this content|this resource requires permission|authorization required|authentication required|please log in to continue|sign in to read this article|you must be logged in|you have been logged out|you are signed out|your session has expired please sign in again|this content is for members only|only subscribers can read this|subscribe to continue reading|register to read the full text|this content is not available in your region|your ip address has been blocked|unusual traffic from your network|verify that you are human|complete the captcha or security check to continue|checking your browser before accessing the site|too many attempts|too many visits|rate limit exceeded|your account has been suspended|contact the site owner|the request was blocked|you have reached your limit of free articles|password protected
please enable javascript to continue|javascript is disabled in your browser|javascript is required|javascript must be on|this site requires javascript to work|you need to enable javascript to run this app|turn on javascript and reload the page|your browser does not support javascript|javascript and cookies must be enabled|switch on scripts|scripts are blocked or switched off|your browser blocks scripts|the content cannot be shown without scripts|this page needs client side scripting|active scripting|change your browser setting and reload|please upgrade your browser|loading please wait|if nothing appears|otherwise the page stays blank
text goes here|your text here|your content here|insert text here|sample text|dummy text|dummy paragraph|placeholder text|content placeholder|replace this text with your own words|content to be added|to be supplied|to be announced|tbd|coming soon|under construction|xxx|test test|untitled document|click to edit|example paragraph for layout only|type something here|draft do not publish|not for publication
""",
    "filler": """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua|ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat|duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur|excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum
""",
    "frame": """
home|menu|search|back to top|privacy policy|terms of use|terms of service|contact us|about us|copyright all rights reserved|powered by|cookie policy|skip to content|next chapter|previous chapter|log in register|share|nginx|apache server|feedback|site map|help|retry|version 0|build 0
""",
}

#: Labelled exemplars in simplified and in traditional characters, divided by bars.
HAN = {
    "notice": (
        """
错误|错误代码 0|系统提示|系统消息|出错了|出错啦|页面不存在|页面没有找到|找不到该页面|您访问的页面不存在或已删除|您要查看的内容不存在|该文章已被作者删除|本章节已下架|链接已失效|链接已过期|网址有误|地址无效|内容加载失败|无法加载|无法显示|暂时无法查看|打不开|文件已损坏|视频无法播放|录像无法显示|请求的资源不存在|请稍后再试|请稍候重试|请刷新页面重试|重新加载|点击重试|返回首页|返回上一页|请检查网址是否正确|页面将在 0 秒后自动跳转|正在跳转|如有疑问请联系管理员|给您带来不便敬请谅解|很抱歉|对不起|抱歉
服务器内部错误|服务器繁忙|服务器无响应|服务器没有回应|服务器开小差了|系统繁忙|系统异常|系统维护中|网站正在维护|正在升级|服务暂时不可用|服务不可用|网关超时|网关错误|请求超时|请求失败|请求过多|请求被拒绝|请求编号 0|连接超时|连接失败|连接已断开|网络异常|网络错误|网络不稳定|数据库连接错误|未知错误|程序异常|参数错误|运行错误|技术人员正在处理|工程师正在修复
拒绝访问|访问被拒绝|禁止访问|没有权限|没有访问权限|您没有权限查看此页面|需要权限才能访问|未授权|请先登录|请登录后查看全文|您尚未登录|登录已过期请重新登录|登录状态失效|会话已过期|账号已被停用|账户已被封禁|仅限会员阅读|订阅后继续阅读|注册后阅读全文|购买后阅读|您所在的地区无法查看|访问过于频繁|操作太频繁|检测到异常访问|检测到网络流量异常|请完成安全验证|完成验证后继续访问|请输入验证码|验证码错误|您的网址已被拦截
请启用脚本|请开启脚本功能后继续|请打开浏览器的脚本|脚本已被禁用|您的浏览器禁用了脚本|您的浏览器不支持脚本|浏览器未启用脚本|本页需要脚本才能显示|本站依赖脚本运行|脚本功能已关闭|因为脚本没有运行|页面只能显示空白|内容没有加载|加载正文需要脚本|正在加载请稍候|长时间没有响应|请检查浏览器设置|请更新浏览器|开启后刷新本页|阅读正文请开启
无法打开这一页|没有找到这一章|这一节暂时看不到|本栏目维护中|此内容已删除|投递失败|发送失败|未能送达|未能加载|已停止服务
""",
        """
錯誤|錯誤代碼 0|系統提示|系統消息|出錯了|出錯啦|頁面不存在|頁面沒有找到|找不到該頁面|您訪問的頁面不存在或已刪除|您要查看的內容不存在|該文章已被作者刪除|本章節已下架|鏈接已失效|鏈接已過期|網址有誤|地址無效|內容加載失敗|無法加載|無法顯示|暫時無法查看|打不開|文件已損壞|視頻無法播放|錄像無法顯示|請求的資源不存在|請稍後再試|請稍候重試|請刷新頁面重試|重新加載|點擊重試|返回首頁|返回上一頁|請檢查網址是否正確|頁面將在 0 秒後自動跳轉|正在跳轉|如有疑問請聯繫管理員|給您帶來不便敬請諒解|很抱歉|對不起|抱歉
服務器內部錯誤|服務器繁忙|服務器無響應|服務器沒有回應|服務器開小差了|系統繁忙|系統異常|系統維護中|網站正在維護|正在升級|服務暫時不可用|服務不可用|網關超時|網關錯誤|請求超時|請求失敗|請求過多|請求被拒絕|請求編號 0|連接超時|連接失敗|連接已斷開|網絡異常|網絡錯誤|網絡不穩定|數據庫連接錯誤|未知錯誤|程序異常|參數錯誤|運行錯誤|技術人員正在處理|工程師正在修復
拒絕訪問|訪問被拒絕|禁止訪問|沒有權限|沒有訪問權限|您沒有權限查看此頁面|需要權限才能訪問|未授權|請先登錄|請登錄後查看全文|您尚未登錄|登錄已過期請重新登錄|登錄狀態失效|會話已過期|賬號已被停用|賬戶已被封禁|僅限會員閱讀|訂閱後繼續閱讀|註冊後閱讀全文|購買後閱讀|您所在的地區無法查看|訪問過於頻繁|操作太頻繁|檢測到異常訪問|檢測到網絡流量異常|請完成安全驗證|完成驗證後繼續訪問|請輸入驗證碼|驗證碼錯誤|您的網址已被攔截
請啟用腳本|請開啟腳本功能後繼續|請打開瀏覽器的腳本|腳本已被禁用|您的瀏覽器禁用了腳本|您的瀏覽器不支持腳本|瀏覽器未啟用腳本|本頁需要腳本才能顯示|本站依賴腳本運行|腳本功能已關閉|因為腳本沒有運行|頁面只能顯示空白|內容沒有加載|加載正文需要腳本|正在加載請稍候|長時間沒有響應|請檢查瀏覽器設置|請更新瀏覽器|開啟後刷新本頁|閱讀正文請開啟
無法打開這一頁|沒有找到這一章|這一節暫時看不到|本欄目維護中|此內容已刪除|投遞失敗|發送失敗|未能送達|未能加載|已停止服務
""",
    ),
    "to come": (
        """
内容待补充|正文待补|待续|此处填写内容|此处插入正文|请在此输入文字|请在此输入标题|示例文本|示例文字|样例文字|占位文字|占位内容|测试测试|测试内容|敬请期待|正在建设|暂无内容|内容整理中|段落文字示意|请替换为正文|仅供排版
""",
        """
內容待補充|正文待補|待續|此處填寫內容|此處插入正文|請在此輸入文字|請在此輸入標題|示例文本|示例文字|樣例文字|佔位文字|佔位內容|測試測試|測試內容|敬請期待|正在建設|暫無內容|內容整理中|段落文字示意|請替換為正文|僅供排版
""",
    ),
    "frame": (
        """
首页|目录|上一章|下一章|返回目录|返回顶部|关于我们|联系我们|隐私政策|使用条款|版权所有|保留所有权利|未经许可不得转载|未经授权禁止转载|版权归作者所有|侵权必究|禁止翻印|请勿用于商业用途|仅供试读|仅供学习|以纸质版为准|登录 注册|分享|收藏|刷新|反馈|帮助|搜索|菜单|意见反馈|电子版
""",
        """
首頁|目錄|上一章|下一章|返回目錄|返回頂部|關於我們|聯繫我們|隱私政策|使用條款|版權所有|保留所有權利|未經許可不得轉載|未經授權禁止轉載|版權歸作者所有|侵權必究|禁止翻印|請勿用於商業用途|僅供試讀|僅供學習|以紙質版為準|登錄 註冊|分享|收藏|刷新|反饋|幫助|搜索|菜單|意見反饋|電子版
""",
    ),
}

#: Labelled exemplars in written Cantonese and in words of the other regions' Chinese.
OTHER = {
    "notice": "呢一頁搵唔到|呢個網頁暫時睇唔到|你冇權限睇呢頁|請登入之後先繼續睇|請開啟腳本先可以睇|系統出咗問題|遲啲再試|伺服器錯誤|伺服器忙碌中|找不到網頁|網路連線逾時|載入失敗|重新載入|請重新登入|啟用指令碼|權限不足|使用者未登入|連結已失效",
    "to come": "內容稍後補上|文字預留位置|預留文字",
    "frame": "回到頁首|著作權所有|聯絡我們|隱私權政策|登入",
}


def _split(block: str) -> list[str]:
    return [x.strip() for x in block.replace("\n", "|").split("|") if x.strip()]


def labelled() -> Iterator[tuple[str, str]]:
    """``(label, text)`` of every exemplar. A notice that text is to come is a notice."""
    for label, text in _all():
        yield "notice" if label == "to come" else label, text


def _all() -> Iterator[tuple[str, str]]:
    for label, block in LATIN.items():
        yield from ((label, text) for text in _split(block))
    for label, blocks in HAN.items():
        yield from ((label, text) for block in blocks for text in _split(block))
    for label, block in OTHER.items():
        yield from ((label, text) for text in _split(block))


def one_script() -> dict[int, str]:
    """Which traditional characters are which simplified ones, read off the exemplars that stand in both."""
    pairs = [pair for blocks in HAN.values() for pair in zip(*map(_split, blocks), strict=True)]
    return {ord(t): s for simplified, traditional in pairs for s, t in zip(simplified, traditional, strict=True) if s != t}
